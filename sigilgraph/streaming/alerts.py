"""Alert streams: parsing, deduplication by watermark, stream-static enrichment, event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALERT = "alert_id string, source string, zone string, ts timestamp, threat struct<indicator:string, type:string, malware:string, cve:string, severity:int>"


def parse(raw: DataFrame, column: str = "value") -> DataFrame:
    """Alerts of JSON text; malformed messages are dropped."""
    return raw.select(F.from_json(column, ALERT).alias("a")).where(F.col("a.alert_id").isNotNull()).select("a.*")


def deduplicated(alerts: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """Each alert_id once within the watermark: replayed and overlapping reads do no harm."""
    return alerts.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["alert_id"])


def context(indicators: DataFrame, indicates: DataFrame, attributed: DataFrame, sourced: DataFrame) -> DataFrame:
    """One row for each indicator value: first, last, malware and actors; each relation is folded before it is joined."""
    times = sourced.groupBy("value").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    malware = indicates.groupBy("value").agg(F.array_sort(F.collect_set("malware")).alias("malware"))
    actors = indicates.join(attributed, "malware").groupBy("value").agg(F.array_sort(F.collect_set("actor")).alias("actors"))
    return indicators.join(times, "value", "left").join(malware, "value", "left").join(actors, "value", "left")


def enrich(alerts: DataFrame, known: DataFrame) -> DataFrame:
    """Alerts (stream or batch) with their indicator's context and recommendations; unknown indicators stay."""
    k = known.select(F.col("value").alias("__v"), "confidence", "malware", "actors")
    j = alerts.join(k, F.col("threat.indicator") == F.col("__v"), "left").drop("__v")
    none = F.array().cast("array<string>")
    malware = F.array_sort(F.array_distinct(F.array_compact(F.array_append(F.coalesce("malware", none), F.col("threat.malware")))))
    advice = F.array_compact(F.array(F.when(F.col("threat.severity") >= 8, "isolate the host"), F.when(F.size(malware) > 0, "scan for malware"), F.when(F.col("threat.cve").isNotNull(), "patch the vulnerability"), F.when(F.col("confidence").isNull(), "review by an analyst")))
    return j.withColumn("malware", malware).withColumn("recommendations", advice)


def rates(alerts: DataFrame, every: str = "1 hour", lateness: str = "10 minutes", *keys: str) -> DataFrame:
    """Alerts by tumbling window (an extension: the batch service has no windows)."""
    return alerts.withWatermark("ts", lateness).groupBy(F.window("ts", every), *keys).agg(F.count("*").alias("alerts")).select(F.col("window.start").alias("start"), *keys, "alerts")


def sessions(alerts: DataFrame, key: str, gap: str = "30 minutes", lateness: str = "10 minutes") -> DataFrame:
    return alerts.withWatermark("ts", lateness).groupBy(F.session_window("ts", gap), key).agg(F.count("*").alias("alerts")).select(F.col("session_window.start").alias("start"), key, "alerts")


def replace_by_key(path: str, key: str):
    """A foreachBatch sink that a replayed batch leaves unchanged: each batch has its own folder, written over."""

    def write(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates([key]).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write
