"""Queries over text, JSON and event streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import zones as Z
from ..session import scratch_path
from ..streaming import alerts as A
from .catalog import query

#: Words of the synthetic corpus in place of sector words, which it does not have.
WORDS = {"energy": ["the", "the and"], "finance": ["der", "die"], "healthcare": ["que"]}
_HAS = "regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{N}}_])({0})([^\\p{{L}}\\p{{N}}_]|$)')"


@query("Z1_zone_scores", f"""SELECT doc_id, array_to_string(list_filter([CASE WHEN {_HAS.format('the')} THEN 'energy' ELSE '' END, CASE WHEN {_HAS.format('der|die')} THEN 'finance' ELSE '' END, CASE WHEN {_HAS.format('que')} THEN 'healthcare' ELSE '' END], lambda x: x <> ''), '|') AS zones FROM documents""")
def zone_scores(t):
    out = Z.detect_zones(t.documents.select("doc_id", "text"), "text", "body", keywords=WORDS, excluding={}, default="")
    return out.select("doc_id", F.array_join("zones", "|").alias("zones"))


@query("F_event_rates", "SELECT epoch(date_trunc('hour', ts))::BIGINT AS start, event_type, count(*) AS alerts FROM events GROUP BY 1, 2")
def rates(t):
    return A.rates(t.events, "1 hour", "10 minutes", "event_type").withColumn("start", F.unix_timestamp("start"))


@query("STREAM_alert_counts", "SELECT event_type AS type, count(*) AS alerts FROM events GROUP BY event_type")
def stream_counts(t):
    """The event table read as a file stream, parsed from JSON, deduplicated and written by an available-now trigger, then counted."""
    spark = t.spark
    base = scratch_path(spark, "alerts")
    alert = F.to_json(F.struct(F.col("event_id").cast("string").alias("alert_id"), F.lit("s").alias("source"), F.lit("global").alias("zone"), F.col("ts"), F.struct(F.col("user_id").cast("string").alias("indicator"), F.col("event_type").alias("type")).alias("threat")))
    rows = t.events.select(alert.alias("value"))
    rows.unionByName(rows.limit(100)).write.text(f"{base}/in")
    stream = A.deduplicated(A.parse(spark.readStream.schema("value string").text(f"{base}/in")), "60 days")
    done = stream.select("alert_id", F.col("threat.type").alias("type")).writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    done.awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("type").agg(F.count("*").alias("alerts"))


@query("ALERT_enrichment", """WITH a AS (SELECT event_id, event_id AS k, user_id FROM events), m AS (SELECT indicator_id, string_agg(DISTINCT malware_id::VARCHAR, '|' ORDER BY malware_id::VARCHAR) AS malware FROM indicates GROUP BY indicator_id)
  SELECT event_id, l.confidence, coalesce(m.malware, '') AS malware FROM a LEFT JOIN live l ON l.indicator_id = a.k LEFT JOIN m ON m.indicator_id = l.indicator_id""")
def alert_enrichment(t):
    known = t.live.select(F.col("indicator_id").cast("string").alias("value"), "confidence")
    times = t.live.select(F.col("indicator_id").cast("string").alias("value"), F.col("first_seen").alias("first"), F.col("last_seen").alias("last"))
    indicates = t.indicates.select(F.col("indicator_id").cast("string").alias("value"), F.col("malware_id").cast("string").alias("malware"))
    attributed = t.malware.select(F.col("malware_id").cast("string").alias("malware"), F.col("nationkey").cast("string").alias("actor"))
    none = F.lit(None).cast("string")
    threat = F.struct(F.col("event_id").cast("string").alias("indicator"), none.alias("malware"), none.alias("cve"), F.lit(5).alias("severity"))
    out = A.enrich(t.events.select("event_id", threat.alias("threat")), A.context(known, indicates, attributed, times))
    return out.select("event_id", "confidence", F.array_join("malware", "|").alias("malware"))
