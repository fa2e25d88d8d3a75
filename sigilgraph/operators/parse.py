"""Staging events to typed items: explode attributes, read tags, dedup inside the event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import tags as G
from .merge import first_of


def explode_events(events: DataFrame) -> DataFrame:
    """Rows of attributes (event_id, idx, attr_type, value, tags, event_tags) of nested staging events (id, tags, attributes)."""
    rows = events.select(F.col("id").alias("event_id"), F.transform("tags", lambda t: t["name"]).alias("event_tags"), F.posexplode("attributes").alias("idx", "a"))
    return rows.select("event_id", "idx", F.col("a.type").alias("attr_type"), F.col("a.value").alias("value"), F.transform(F.coalesce("a.tags", F.array().cast("array<struct<name:string>>")), lambda t: t["name"]).alias("tags"), "event_tags", F.col("a.comment").alias("comment"))


def parse_attributes(attrs: DataFrame) -> DataFrame:
    """Items of attributes (event_id, idx, attr_type, value, tags, event_tags, comment): kind, key, source, zones, confidence, severity,
    score, and what comments name: used techniques, tactic phases and a feed's own data as JSON. Blank and oversized values are rejected."""
    ok = attrs.where(S.accepted_value(F.col("value")))
    kind = F.when(F.col("attr_type") == "vulnerability", "vulnerability").when(F.col("attr_type") == "threat-actor", "actor").when(F.col("attr_type") == "malware-type", "malware")
    text = F.when(F.col("attr_type") == "text", F.when(F.col("value").rlike(r"^T\d{4}"), "technique").when(F.col("value").rlike(r"^TA\d{4}"), "tactic").when(F.col("value").rlike(r"^S\d{4}"), "tool"))
    meta = G.meta_json(F.col("comment"), "NVD_META:")
    feed = F.coalesce(G.meta_json(F.col("comment"), "OTX_META:"), G.meta_json(F.col("comment"), "TF_META:"))
    uses, phases = G.meta_list(F.col("comment"), "MITRE_USES_TECHNIQUES:", "t"), G.meta_list(F.col("comment"), "MITRE_TACTIC_PHASES:", "p")
    own, event = G.zones_of(F.col("tags")), G.zones_of(F.col("event_tags"))
    rows = ok.select("event_id", "idx", F.coalesce(kind, text, F.lit("indicator")).alias("kind"), "attr_type", "value", G.source_of(F.col("tags")).alias("source"), G.resolve_zones(own, event).alias("zones"), G.confidence_of(F.col("tags")).alias("confidence"), G.severity_of(F.col("tags")).alias("severity"), F.coalesce(G.meta_score(meta), G.tag_score(F.col("tags"))).alias("score"), uses.alias("uses_techniques"), phases.alias("tactic_phases"), feed.alias("feed_meta"))
    itype = S.lookup(S.ATTRIBUTE_TYPES, F.col("attr_type"), "unknown")
    key = F.when(F.col("kind") == "vulnerability", F.concat(F.lit("cve:"), F.upper(F.trim("value")))).when(F.col("kind") == "indicator", F.concat(itype, F.lit(":"), F.trim("value"))).otherwise(F.concat("kind", F.lit(":"), F.trim("value")))
    return rows.withColumn("key", key)


def dedup_items(items: DataFrame) -> DataFrame:
    """The first item of each key in an event."""
    return first_of(items, ["event_id", "key"], ["idx"])


def keep_events(index: DataFrame, prefix: str, since) -> DataFrame:
    """Events of the index whose name has the prefix, not older than ``since``: by timestamp, else by date with one day of grace, else kept."""
    fresh = F.when(F.col("ts").isNotNull(), F.col("ts") >= since).when(F.col("date").isNotNull(), F.col("date") >= F.date_sub(F.to_date(since), 1)).otherwise(F.lit(True))
    return index.where(F.col("info").startswith(prefix) & fresh)
