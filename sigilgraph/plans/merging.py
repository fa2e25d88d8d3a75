"""Queries of upserts and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merge as M
from .catalog import query

_FOLD = "CASE WHEN len(list_filter({0}, lambda x: x <> 'global')) > 0 THEN array_to_string(list_sort(list_filter({0}, lambda x: x <> 'global')), '|') ELSE array_to_string(list_sort({0}), '|') END"


@query("M1_node_merge", f"""WITH a AS (SELECT indicator_id, max(confidence) AS confidence, min(seen) AS f, max(seen) AS l, arg_min(source_name, seq) AS tag, arg_max(zone, seq) AS last_zone, list_sort(list_distinct(list(source_name))) AS sources, list_distinct(list(zone)) AS z FROM attribute GROUP BY indicator_id)
  SELECT indicator_id, confidence, epoch(f)::BIGINT AS first_seen, epoch(l)::BIGINT AS last_seen, tag, last_zone, array_to_string(sources, '|') AS sources, {_FOLD.format('z')} AS zones FROM a""")
def node_merge(t):
    claims = t.attribute.select("indicator_id", "seq", "confidence", F.col("seen").alias("first_seen"), F.col("seen").alias("last_seen"), F.col("source_name").alias("tag"), F.col("zone").alias("last_zone"), F.array("source_name").alias("sources"), F.array("zone").alias("zones"))
    out = M.merge_nodes(claims, ["indicator_id"], "seq", highest=["confidence"], earliest=["first_seen"], latest=["last_seen"], first=["tag"], last=["last_zone"], sets=["sources"], zones="zones")
    return out.select("indicator_id", "confidence", F.unix_timestamp("first_seen").alias("first_seen"), F.unix_timestamp("last_seen").alias("last_seen"), "tag", "last_zone", F.array_join("sources", "|").alias("sources"), F.array_join("zones", "|").alias("zones"))


@query("M2_provenance", "SELECT indicator_id, source_name, epoch(min(seen))::BIGINT AS first, epoch(max(seen))::BIGINT AS last, arg_min(zone, seq) AS raw, count(*) AS claims FROM attribute GROUP BY indicator_id, source_name")
def provenance(t):
    claims = t.attribute.select("indicator_id", "source_name", F.col("seen").alias("first"), F.col("seen").alias("last"), F.col("zone").alias("raw"), "seq")
    out = M.merge_provenance(claims, ["indicator_id"], "source_name", "first", "last", "raw", "seq")
    return out.withColumns({"first": F.unix_timestamp("first"), "last": F.unix_timestamp("last")})


@query("M4_last_non_null", "SELECT indicator_id, arg_max(CASE WHEN confidence < 0.6 THEN zone END, CASE WHEN confidence < 0.6 THEN seq END) AS zone FROM attribute GROUP BY indicator_id")
def last_non_null(t):
    rows = t.attribute.withColumn("zone", F.when(F.col("confidence") < 0.6, F.col("zone")))
    return rows.groupBy("indicator_id").agg(M.last_value("zone", "seq").alias("zone"))


@query("M8_edge_merge", """WITH n AS (SELECT indicator_id, malware_id, arg_max(confidence, seq) AS c, list_sort(list_distinct(list(source_name))) AS s FROM attribute GROUP BY indicator_id, malware_id),
  o AS (SELECT indicator_id, malware_id, 0.42e0 AS oc, 'old' AS os, indicator_id % 2 = 0 AS frozen FROM indicates WHERE malware_id % 3 = 0)
  SELECT n.indicator_id, n.malware_id, CASE WHEN frozen THEN oc ELSE c END AS confidence, array_to_string(CASE WHEN os IS NULL THEN s ELSE list_sort(list_append(s, os)) END, '|') AS sources FROM n LEFT JOIN o ON n.indicator_id = o.indicator_id AND n.malware_id = o.malware_id""")
def edge_merge(t):
    keys = ["indicator_id", "malware_id"]
    claims = t.attribute.select(*keys, "seq", "confidence", F.lit("m").alias("match_type"), F.col("source_name").alias("source"), F.array(F.col("event_id").cast("string")).alias("event_ids"))
    old = t.indicates.where("malware_id % 3 = 0").select(*keys, F.lit(0.42).alias("confidence"), F.lit("m").alias("match_type"), F.array(F.lit("old")).alias("sources"), F.array().cast("array<string>").alias("event_ids"), F.when(F.col("indicator_id") % 2 == 0, F.lit("2024-01-01").cast("timestamp")).alias("calibrated_at"))
    return M.merge_edges(claims, keys, "seq", old).select(*keys, "confidence", F.array_join("sources", "|").alias("sources"))


@query("M11_first_of_key", "SELECT indicator_id, event_id, idx FROM (SELECT *, row_number() OVER (PARTITION BY indicator_id ORDER BY seq) AS n FROM attribute) x WHERE n = 1")
def first_of_key(t):
    return M.first_of(t.attribute.select("indicator_id", "seq", "event_id", "idx"), ["indicator_id"], ["seq"]).drop("seq")


@query("U1_event_dedup", "SELECT event_id, kind, min(idx) AS idx FROM (SELECT event_id, idx, indicator_id % 3 AS kind FROM attribute) x GROUP BY event_id, kind")
def event_dedup(t):
    return M.first_of(t.attribute.select("event_id", (F.col("indicator_id") % 3).alias("kind"), "idx"), ["event_id", "kind"], ["idx"])


@query("K1_J22_new_only", "SELECT count(*) AS n, sum(k) AS total FROM (SELECT DISTINCT indicator_id AS k FROM attribute WHERE indicator_id NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)) x")
def new_only(t):
    stored = t.part.where("p_size > 10").select(F.col("p_partkey").alias("k"))
    return M.new_only(t.attribute.select(F.col("indicator_id").alias("k")), stored, ["k"]).agg(F.count("*").alias("n"), F.sum("k").alias("total"))


@query("M12_labels", f"SELECT actor_id, CASE WHEN zone = 'global' THEN '' ELSE upper(substr(zone, 1, 1)) || substr(zone, 2) END AS labels FROM actor")
def labels(t):
    return t.actor.select("actor_id", F.array_join(M.secondary_labels(F.array("zone")), "|").alias("labels"))
