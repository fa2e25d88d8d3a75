"""Queries of change sets, cursors, phrases, copies of a graph and text containment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import zones as Z
from ..functions.ident import node_uuid
from ..operators import changes as C
from ..operators import link as L
from ..operators.store import KeyedTable, Rules
from ..session import scratch_path
from ..sources import cursor as K
from .catalog import query
from .exports import _SHA, _UUID

c = F.col


@query("B12_S16_cursor", """WITH m AS (SELECT max(o_orderdate) AS top FROM orders WHERE o_orderkey % 4 < 2 AND o_orderdate < TIMESTAMP '1997-01-01'),
  s AS (SELECT * FROM orders WHERE o_orderkey % 4 < 2 AND o_orderdate < TIMESTAMP '1997-01-01' UNION ALL SELECT orders.* FROM orders, m WHERE NOT (o_orderkey % 4 < 2 AND o_orderdate < TIMESTAMP '1997-01-01') AND o_orderdate >= top - INTERVAL 200 DAY)
  SELECT o_orderkey AS key, o_totalprice AS price, epoch(o_orderdate)::BIGINT AS "at", epoch((SELECT max(o_orderdate) FROM orders))::BIGINT AS cursor FROM s""")
def cursor(t):
    """A feed in two runs: what comes late is read again within the overlap of 200 days, and what comes twice is one row."""
    base = scratch_path(t.spark, "feed")
    cursors = K.Cursors(t.spark, f"{base}/cursors")
    table = KeyedTable(t.spark, f"{base}/rows", Rules(["key"], "at", last=["price"], latest=["at"]), buckets=4)
    first = (c("o_orderkey") % 4 < 2) & (c("o_orderdate") < F.lit("1997-01-01").cast("timestamp"))
    for part in (first, ~first):
        t.orders.where(part).select(c("o_orderkey").alias("key"), c("o_totalprice").alias("price"), c("o_orderdate").alias("at")).write.mode("append").parquet(f"{base}/in")
        K.sync(t.spark.read.parquet(f"{base}/in"), "orders", "at", table, cursors, 200 * 86400)
    at = cursors.table.read().where("source = 'orders'").select(F.unix_timestamp("cursor").alias("cursor"))
    return table.read().select("key", "price", F.unix_timestamp("at").alias("at")).join(F.broadcast(at))  # one row


def _links(t, rows: DataFrame) -> DataFrame:
    attributed = t.malware.select(c("malware_id").alias("malware"), c("nationkey").cast("string").alias("actor"))
    live = rows.groupBy("indicator_id").agg(F.max_by("active", "seq").alias("active"), F.min("seen").alias("first_seen")).join(t.indicator.select("indicator_id", "value"), "indicator_id")
    pairs = rows.select(c("indicator_id").alias("indicator"), c("malware_id").alias("malware")).distinct()
    return C.campaign_links(attributed, pairs, live.withColumnRenamed("indicator_id", "indicator"), 20)


def _links_sql(name: str, rows: str) -> str:
    return f"""{name} AS (SELECT actor || ' Campaign' AS campaign, 'Indicator' AS label, indicator_id::VARCHAR AS member FROM (SELECT p.actor, l.indicator_id, row_number() OVER (PARTITION BY p.actor ORDER BY l.f DESC, i.value, l.indicator_id) AS n
    FROM (SELECT DISTINCT m.nationkey::VARCHAR AS actor, indicator_id FROM {rows} a JOIN malware m ON m.malware_id = a.malware_id) p JOIN (SELECT indicator_id, max_by(active, seq) AS active, min(seen) AS f FROM {rows} a GROUP BY indicator_id) l ON l.indicator_id = p.indicator_id AND l.active JOIN indicator i ON i.indicator_id = l.indicator_id) x WHERE n <= 20)"""


@query("E2b_link_changes", f"""WITH old AS (SELECT * FROM attribute WHERE event_id % 2 = 0), {_links_sql('w', 'attribute')}, {_links_sql('s', 'old')},
  mw AS (SELECT DISTINCT nationkey::VARCHAR || ' Campaign' AS campaign, malware_id::VARCHAR AS member FROM malware)
  SELECT campaign, 'Malware' AS label, member, 'insert' AS op FROM mw WHERE member::BIGINT % 3 > 0
  UNION ALL (SELECT campaign, label, member, 'insert' FROM w EXCEPT SELECT campaign, label, member, 'insert' FROM s) UNION ALL (SELECT campaign, label, member, 'delete' FROM s EXCEPT SELECT campaign, label, member, 'delete' FROM w)""")
def link_changes(t):
    """Links of campaigns as half of the reports made them, against those of all: stale links of indicators go, those of malware never."""
    stored = _links(t, t.attribute.where("event_id % 2 = 0")).where("label <> 'Malware' OR cast(member AS bigint) % 3 = 0")
    gone = t.spark.range(1).select(F.lit("0 Campaign").alias("campaign"), F.lit("Malware").alias("label"), F.lit("gone").alias("member"))
    return C.link_changes(_links(t, t.attribute), stored.unionByName(gone))


@query("E6_change_sets", """WITH h AS (SELECT indicator_id, max(CASE WHEN active THEN 1 ELSE 0 END) = 1 AS hit FROM attribute GROUP BY indicator_id)
  SELECT indicator_id, hit AS active FROM h JOIN indicator i USING (indicator_id) WHERE indicator_id % 7 > 0 AND hit IS DISTINCT FROM CASE indicator_id % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END""")
def activity_changes(t):
    flag = F.when(c("indicator_id") % 3 == 0, True).when(c("indicator_id") % 3 == 1, False)
    nodes = t.indicator.select("indicator_id", flag.alias("active"), F.when(c("indicator_id") % 7 == 0, F.lit("2024-01-01").cast("timestamp")).alias("retired_at"))
    return C.activity_changes(nodes, t.indicator_event, t.attribute.where("active"), "indicator_id")


def _hits(text: str, words: list[str]) -> str:
    return " + ".join(f"len(regexp_extract_all({text}, '\\b{w.replace('-', chr(92) + '-')}\\b'))" for w in words)


def _planted(as_sql: bool):
    """Texts with a keyword of each zone by row, some of them excluded, and one that another keyword stands in."""
    kinds = [(z, len(w)) for z, w in Z.KEYWORDS.items()]
    if as_sql:
        pick = lambda z, words, n: f"list_extract([{', '.join(chr(39) + w + chr(39) for w in words)}], (p_partkey % {n})::INTEGER + 1)"
        parts = " || ".join(f"CASE WHEN p_size % {k + 2} = 0 THEN ', ' || {pick(z, Z.KEYWORDS[z], n)} || '.' ELSE '' END" for k, (z, n) in enumerate(kinds))
        bad = " || ".join(f"CASE WHEN p_partkey % {11 + k} = 0 THEN ' but ' || {pick(z, Z.EXCLUDING[z], len(Z.EXCLUDING[z]))} ELSE '' END" for k, z in enumerate(Z.EXCLUDING))
        return f"p_name || {parts} || {bad}"
    at = lambda words: F.element_at(F.array(*map(F.lit, words)), (c("p_partkey") % len(words)).cast("int") + 1)
    parts = [F.when(c("p_size") % (k + 2) == 0, F.concat(F.lit(", "), at(Z.KEYWORDS[z]), F.lit("."))).otherwise("") for k, (z, _) in enumerate(kinds)]
    bad = [F.when(c("p_partkey") % (11 + k) == 0, F.concat(F.lit(" but "), at(Z.EXCLUDING[z]))).otherwise("") for k, z in enumerate(Z.EXCLUDING)]
    return F.concat(c("p_name"), *parts, *bad)


_SCORES = ", ".join(f"CASE WHEN {_hits('low', Z.EXCLUDING[z])} > 0 THEN 0e0 ELSE 2e0 * ({_hits('low', w)}) END AS {z}" for z, w in Z.KEYWORDS.items())


@query("Z2_Z4_keywords", f"""WITH p AS (SELECT p_partkey, lower({_planted(True)}) AS low FROM part), s AS (SELECT p_partkey, {_SCORES} FROM p)
  SELECT *, coalesce(nullif(concat_ws('|', {', '.join(f"CASE WHEN {z} >= 1.5 THEN '{z}' END" for z in Z.KEYWORDS)}), ''), 'global') AS zones FROM s""")
def keywords(t):
    """All keywords of the zones, weighted as a description, with excluding phrases."""
    rows = t.part.select("p_partkey", _planted(False).alias("text"))
    told = Z.detect_zones(rows.withColumn("s", Z.zone_scores(c("text"), "description")), "text", "description")
    return told.select("p_partkey", *[c("s")[z].alias(z) for z in Z.KEYWORDS], F.array_join("zones", "|").alias("zones"))


@query("J26_Q21_uuid_delta", f"""WITH v AS (SELECT 'Vulnerability' AS label, cve_id, score FROM vulnerability UNION ALL SELECT 'CVE', cve_id, score FROM cve),
  u AS (SELECT label, cve_id, score, {_UUID.format(_SHA.format("'vulnerability:' || lower(cve_id)"))} AS uuid, length(cve_id) % 3 AS k, right(cve_id, 1) AS d FROM v)
  SELECT uuid, label, CASE WHEN d = '3' THEN 'only here' WHEN d = '4' THEN 'only there' WHEN d IN ('6', '8') AND score IS NOT NULL THEN 'changed' ELSE 'same' END AS status FROM u""")
def uuid_delta(t):
    """Two copies of all vulnerabilities of both labels, which share their ids."""
    rows = t.vulnerability.select(F.lit("Vulnerability").alias("label"), "cve_id", "score", "severity").unionByName(t.cve.select(F.lit("CVE").alias("label"), "cve_id", "score", "severity"))
    rows = rows.withColumn("uuid", node_uuid("Vulnerability", [c("cve_id")]))
    last = F.right("cve_id", F.lit(1))
    there = rows.where(last != "3").withColumn("score", F.when(last.isin("6", "8"), c("score") + 1).otherwise(c("score")))
    return C.delta(rows.where(last != "4"), there, ["uuid", "label"], ["cve_id", "score", "severity"])


_CPE = "'cpe:2.3:a:' || lower(p_brand) || ':' || lower(p_type) || ':' || p_size"


@query("J27_cpe_bridge", f"SELECT DISTINCT v.p_partkey AS cve, s.p_partkey AS software FROM (SELECT p_partkey, substr({_CPE}, CASE WHEN p_partkey % 4 = 0 THEN 9 ELSE 1 END) AS cpe FROM part WHERE p_partkey % 2 = 0) v JOIN (SELECT p_partkey, {_CPE} || ':*:' || p_name AS version FROM part) s ON contains(s.version, v.cpe)")
def cpe_bridge(t):
    """Software versions that hold a vulnerability's product name, whole or from its vendor on."""
    cpe = F.concat(F.lit("cpe:2.3:a:"), F.lower("p_brand"), F.lit(":"), F.lower("p_type"), F.lit(":"), c("p_size").cast("string"))
    needles = t.part.where("p_partkey % 2 = 0").select(c("p_partkey").alias("needle"), F.when(c("p_partkey") % 4 == 0, F.substring(cpe, 9, 1 << 20)).otherwise(cpe).alias("part"))
    versions = t.part.select(c("p_partkey").alias("text_id"), F.concat(cpe, F.lit(":*:"), "p_name").alias("text"))
    return L.contains_join(needles, versions).select(c("needle").alias("cve"), c("text_id").alias("software"))
