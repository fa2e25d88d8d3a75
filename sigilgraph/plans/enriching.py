"""Queries of enrichment jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import enrich as E
from .catalog import query

_AS_OF = "TIMESTAMP '2002-01-01 00:00:00'"
_SIZES = "s AS (SELECT event_id, count(DISTINCT indicator_id) AS size FROM indicator_event GROUP BY event_id)"
_TIER = "CASE WHEN {0} <= 10 THEN 0.5e0 WHEN {0} <= 20 THEN 0.45e0 WHEN {0} <= 100 THEN 0.4e0 WHEN {0} <= 500 THEN 0.35e0 ELSE 0.3e0 END"


def _indicators(t):
    zones = t.attribute.groupBy("indicator_id").agg(F.collect_set("zone").alias("zones"))
    live = t.live.select("indicator_id", "value", "active", "first_seen", "last_seen")
    return live.join(zones, "indicator_id").withColumnRenamed("indicator_id", "indicator")


def _graph(t):
    attributed = t.malware.select(F.col("malware_id").alias("malware"), F.col("nationkey").cast("string").alias("actor"))
    return attributed, t.indicates.select(F.col("indicator_id").alias("indicator"), F.col("malware_id").alias("malware"))


@query("E2_campaign_rollup", """WITH z AS (SELECT indicator_id, list_distinct(list(zone)) AS zs FROM attribute GROUP BY indicator_id),
  p AS (SELECT DISTINCT m.nationkey AS actor, i.indicator_id FROM malware m JOIN indicates i ON m.malware_id = i.malware_id),
  j AS (SELECT p.actor, l.first_seen, l.last_seen, zs FROM p JOIN live l ON p.indicator_id = l.indicator_id JOIN z ON z.indicator_id = p.indicator_id WHERE l.active),
  g AS (SELECT actor, count(*) AS indicator_count, min(first_seen) AS f, max(last_seen) AS l, list_distinct(flatten(list(zs))) AS za FROM j GROUP BY actor)
  SELECT g.actor::VARCHAR || ' Campaign' AS name, indicator_count, mc AS malware_count, epoch(f)::BIGINT AS first_seen, epoch(l)::BIGINT AS last_seen, CASE WHEN len(list_filter(za, lambda x: x <> 'global')) > 0 THEN array_to_string(list_sort(list_filter(za, lambda x: x <> 'global')), '|') ELSE 'global' END AS zones
  FROM g JOIN (SELECT nationkey, count(DISTINCT malware_id) AS mc FROM malware GROUP BY nationkey) c ON c.nationkey = g.actor""")
def campaign_rollup(t):
    out = E.campaigns(*_graph(t), _indicators(t))
    return out.select("name", "indicator_count", "malware_count", F.unix_timestamp("first_seen").alias("first_seen"), F.unix_timestamp("last_seen").alias("last_seen"), F.array_join("zone", "|").alias("zones"))


@query("E2_sourced_times", """WITH s AS (SELECT indicator_id, min(seen) AS f, max(seen) AS l FROM attribute WHERE source_name <> 'Elsewhere' GROUP BY indicator_id),
  p AS (SELECT DISTINCT m.nationkey AS actor, i.indicator_id FROM malware m JOIN indicates i ON m.malware_id = i.malware_id)
  SELECT p.actor::VARCHAR AS actor, epoch(min(coalesce(s.f, v.first_seen)))::BIGINT AS first_seen, epoch(max(coalesce(s.l, v.last_seen)))::BIGINT AS last_seen FROM p JOIN live v ON p.indicator_id = v.indicator_id LEFT JOIN s ON s.indicator_id = p.indicator_id WHERE v.active GROUP BY p.actor""")
def sourced_times(t):
    sourced = t.attribute.where("source_name <> 'Elsewhere'").select(F.col("indicator_id").alias("indicator"), F.col("seen").alias("first"), F.col("seen").alias("last"))
    out = E.campaigns(*_graph(t), _indicators(t), sourced)
    return out.select("actor", F.unix_timestamp("first_seen").alias("first_seen"), F.unix_timestamp("last_seen").alias("last_seen"))


@query("T7_top_members", """WITH p AS (SELECT DISTINCT m.nationkey AS actor, i.indicator_id FROM malware m JOIN indicates i ON m.malware_id = i.malware_id)
  SELECT actor, value, n AS rank FROM (SELECT p.actor::VARCHAR AS actor, l.value, row_number() OVER (PARTITION BY p.actor ORDER BY l.first_seen DESC NULLS FIRST, l.value) AS n FROM p JOIN live l ON p.indicator_id = l.indicator_id WHERE l.active) x WHERE n <= 100""")
def top_members(t):
    return E.top_members(*_graph(t), _indicators(t)).select("actor", "value", F.col("rank").cast("long").alias("rank"))


@query("A8_event_sizes", f"WITH {_SIZES} SELECT event_id, size FROM s")
def sizes(t):
    return E.event_sizes(t.indicator_event.withColumnRenamed("indicator_id", "indicator"))


@query("E3_calibration", f"""WITH {_SIZES}, m AS (SELECT indicator_id, max(size) AS size FROM indicator_event e JOIN s ON s.event_id = e.event_id GROUP BY indicator_id)
  SELECT i.indicator_id AS indicator, malware_id AS trg, CASE WHEN malware_id % 2 = 0 THEN {_TIER.format('size')} ELSE 0.9e0 END AS confidence FROM indicates i JOIN m ON m.indicator_id = i.indicator_id""")
def calibration(t):
    source = F.when(F.col("malware_id") % 2 == 0, F.array(F.lit("misp"), F.lit("misp_cooccurrence"))).otherwise(F.array(F.lit("misp")))
    edges = t.indicates.select(F.col("indicator_id").alias("indicator"), F.col("malware_id").alias("trg"), source.alias("sources"), F.lit(0.9).alias("confidence"))
    return E.calibrate(edges, t.indicator_event.withColumnRenamed("indicator_id", "indicator")).select("indicator", "trg", "confidence")


@query("E4_decay", f"""SELECT o_orderkey AS key, CASE WHEN d >= 90 AND d < 180 THEN greatest(round(0.5e0 * 0.85e0 * 100) / 100, 0.1e0) WHEN d >= 180 AND d < 365 THEN greatest(round(0.5e0 * 0.7e0 * 100) / 100, 0.1e0) ELSE 0.5e0 END AS confidence, d <= 365 AS active,
  CASE WHEN d > 365 THEN 'retired' WHEN d >= 180 AND d < 365 THEN '180-365' WHEN d >= 90 AND d < 180 THEN '90-180' END AS tier FROM (SELECT o_orderkey, date_sub('day', o_orderdate, TIMESTAMP '1999-06-01') AS d FROM orders) x""")
def decay(t):
    nodes = t.orders.select(F.col("o_orderkey").alias("key"), F.lit(0.5).alias("confidence"), F.lit(True).alias("active"), F.lit(None).cast("string").alias("last_decayed_tier"), F.col("o_orderdate").alias("seen"))
    return E.decay(nodes, "Indicator", "seen", F.lit("1999-06-01").cast("timestamp")).select("key", "confidence", "active", F.col("last_decayed_tier").alias("tier"))


@query("E6_activity", "SELECT indicator_id, max(CASE WHEN active THEN 1 ELSE 0 END) = 1 AS active FROM attribute GROUP BY indicator_id")
def activity(t):
    nodes = t.attribute.select("indicator_id").distinct().select("indicator_id", F.lit(False).alias("active"), F.lit(None).cast("timestamp").alias("retired_at"))
    return E.mark_activity(t.indicator_event, nodes, t.attribute.where("active").select("event_id"), "indicator_id").select("indicator_id", "active")


@query("E7_candidates", "SELECT indicator_id AS key, confidence, n_sources FROM (SELECT indicator_id, n_sources, CASE WHEN indicator_id % 3 = 0 THEN confidence / 2 ELSE confidence END AS confidence FROM live) x WHERE confidence < 0.8 OR n_sources < 2 ORDER BY confidence, indicator_id LIMIT 100")
def candidates(t):
    return E.enrichment_candidates(t.live.select(F.col("indicator_id").alias("key"), F.when(F.col("indicator_id") % 3 == 0, F.col("confidence") / 2).otherwise(F.col("confidence")).alias("confidence"), "n_sources"))


@query("E8_J25_backfill", "SELECT indicator_id, malware_id, count(DISTINCT event_id) AS events, min(event_id) AS first FROM attribute GROUP BY indicator_id, malware_id")
def backfill(t):
    shared = F.slice(F.array_sort(F.collect_set("event_id")), 1, 200)
    return t.attribute.groupBy("indicator_id", "malware_id").agg(shared.alias("e")).select("indicator_id", "malware_id", F.size("e").cast("long").alias("events"), F.element_at("e", 1).alias("first"))
