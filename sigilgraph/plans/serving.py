"""Queries that the service answers, statistics and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import serve as V
from ..operators import stix as X
from .catalog import query


@query("A1_label_counts", "SELECT 'Indicator' AS label, count(*) AS nodes FROM indicator UNION ALL SELECT 'Malware', count(*) FROM malware UNION ALL SELECT 'ThreatActor', count(*) FROM actor UNION ALL SELECT 'Vulnerability', count(*) FROM vulnerability UNION ALL SELECT 'CVE', count(*) FROM cve")
def label_counts(t):
    return V.label_counts({"Indicator": t.indicator, "Malware": t.malware, "ThreatActor": t.actor, "Vulnerability": t.vulnerability, "CVE": t.cve})


@query("A2_by_source", "SELECT source_name AS source, count(DISTINCT indicator_id) AS nodes FROM attribute GROUP BY source_name")
def by_source(t):
    return V.member_counts(t.attribute, F.array("source_name"), "indicator_id", "source")


@query("A3_by_zone", "SELECT zone, count(DISTINCT indicator_id) AS nodes FROM attribute GROUP BY zone")
def by_zone(t):
    return V.member_counts(t.attribute, F.array("zone"), "indicator_id", "zone")


@query("A4_zone_combinations", "SELECT zones, count(*) AS nodes FROM (SELECT indicator_id, string_agg(DISTINCT zone, '+' ORDER BY zone) AS zones FROM attribute GROUP BY indicator_id) x GROUP BY zones")
def combinations(t):
    return V.combination_counts(t.attribute.groupBy("indicator_id").agg(F.collect_set("zone").alias("z")), "z")


@query("A5_active", "SELECT active, count(*) AS nodes FROM live GROUP BY active")
def active(t):
    return t.live.groupBy("active").agg(F.count("*").alias("nodes"))


@query("A6_edge_statistics", "SELECT type, count(*) AS edges, round(avg(confidence), 6) AS avg_confidence FROM edge GROUP BY type")
def edge_statistics(t):
    return V.edge_statistics(t.edge)


@query("A7_severities", "SELECT count(*) FILTER (severity = 'CRITICAL') AS critical, count(*) FILTER (severity = 'HIGH') AS high, count(*) FILTER (severity IS NULL) AS unknown FROM vulnerability")
def severities(t):
    return t.vulnerability.agg(F.count_if(F.col("severity") == "CRITICAL").alias("critical"), F.count_if(F.col("severity") == "HIGH").alias("high"), F.count_if(F.col("severity").isNull()).alias("unknown"))


@query("A9_Q9_collapse", """WITH r AS (SELECT 0 AS o, * FROM vulnerability UNION ALL SELECT 1, * FROM cve),
  g AS (SELECT cve_id, max(score) AS score, arg_min(severity, o) FILTER (severity IS NOT NULL) AS severity, arg_min(description, o) AS description, list_sort(list_distinct(flatten(list(split(zones, ';'))))) AS z, max(kev_added) IS NOT NULL AS is_kev FROM r GROUP BY cve_id)
  SELECT cve_id, score, severity, left(description, 200) AS description, array_to_string(z, '|') AS zones, is_kev FROM g""")
def collapse(t):
    rows = [df.select(F.lit(k).alias("label"), "cve_id", "score", "severity", "description", F.split("zones", ";").alias("zones"), "kev_added") for k, df in (("Vulnerability", t.vulnerability), ("CVE", t.cve))]
    return V.collapse_twins(rows[0].unionByName(rows[1])).withColumn("zones", F.array_join("zones", "|"))


@query("T1_page", "SELECT cve_id, score FROM cve ORDER BY score DESC NULLS FIRST, cve_id LIMIT 20 OFFSET 5")
def paged(t):
    return V.page(t.cve.select("cve_id", "score"), "score", "cve_id", 20, 5)


@query("T8_keyset", "SELECT cve_id FROM cve WHERE cve_id > 'CVE-2024-2' ORDER BY cve_id LIMIT 25")
def keyset(t):
    return V.keyset_page(t.cve.select("cve_id"), "cve_id", "CVE-2024-2", 25)


@query("A14_top_counts", "SELECT indicator_type, count(*) AS nodes FROM indicator GROUP BY indicator_type ORDER BY nodes DESC, indicator_type LIMIT 3")
def top_counts(t):
    return V.top_counts(t.indicator, "indicator_type", 3)


@query("A11_longest_lists", "SELECT indicator_id, count(*) AS n FROM indicator_event GROUP BY indicator_id ORDER BY n DESC, indicator_id LIMIT 200")
def longest(t):
    return t.indicator_event.groupBy("indicator_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "indicator_id").limit(200)


@query("A13_name_audit", "SELECT label, count(*) AS total, count(*) FILTER (regexp_matches(v, '[^A-Za-z0-9 -]')) AS odd FROM (SELECT 'Malware' AS label, name AS v FROM malware UNION ALL SELECT 'Actor', name FROM actor UNION ALL SELECT 'Part', p_type FROM part) x GROUP BY label")
def name_audit(t):
    rows = t.malware.select(F.lit("Malware").alias("label"), F.col("name").alias("v")).unionByName(t.actor.select(F.lit("Actor").alias("label"), F.col("name").alias("v"))).unionByName(t.part.select(F.lit("Part").alias("label"), F.col("p_type").alias("v")))
    return rows.groupBy("label").agg(F.count("*").alias("total"), F.count_if(F.col("v").rlike("[^A-Za-z0-9 -]")).alias("odd"))


@query("A18_invariants", """SELECT (SELECT count(*) FROM indicator WHERE indicator_id NOT IN (SELECT indicator_id FROM indicator_event)) AS without_event, (SELECT count(*) FROM malware WHERE lower(trim(attributed_to)) = 'unknown') AS unattributed""")
def invariants(t):
    from ..functions.ident import is_placeholder

    a = t.indicator.join(t.indicator_event, "indicator_id", "left_anti").agg(F.count("*").alias("without_event"))
    b = t.malware.where(is_placeholder(F.col("attributed_to"))).agg(F.count("*").alias("unattributed"))
    return a.join(F.broadcast(b))


@query("A19_runs", """SELECT grp, count(*) AS runs, round(avg(CASE WHEN ok THEN 1e0 ELSE 0e0 END), 6) AS success, round(avg(CASE WHEN n <= 10 THEN seconds END), 6) AS avg_recent FROM
  (SELECT o_orderpriority AS grp, o_orderstatus <> 'F' AS ok, o_totalprice AS seconds, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) AS n FROM orders) x GROUP BY grp""")
def runs(t):
    rows = t.orders.select(F.col("o_orderpriority").alias("grp"), F.col("o_orderkey").alias("run_id"), "o_orderdate", (F.col("o_orderstatus") != "F").alias("ok"), F.col("o_totalprice").alias("seconds"))
    return V.recent_runs(rows, "grp", "o_orderdate")


@query("A20_by_staging_source", "SELECT split(info, '-')[2] AS source, count(*) AS events, sum(n) AS attributes FROM (SELECT 'KG-' || replace(c_mktsegment, '-', '') || '-' || o_orderkey::VARCHAR AS info, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY info) x GROUP BY 1")
def by_staging_source(t):
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
    info = F.concat(F.lit("KG-"), F.replace("c_mktsegment", F.lit("-"), F.lit("")), F.lit("-"), F.col("o_orderkey").cast("string"))
    return rows.groupBy(F.coalesce(F.get(F.split(info, "-"), F.lit(1)), F.lit("unknown")).alias("source")).agg(F.count("*").alias("events"), F.sum("n").alias("attributes"))


@query("J20_Q2_neighbours", """SELECT id, type, other FROM (SELECT id, type, other, row_number() OVER (PARTITION BY id ORDER BY type, other) AS n FROM (SELECT DISTINCT src AS id, trg AS other, type FROM edge UNION SELECT trg, src, type FROM edge) b WHERE id IN ('I1', 'I50', 'M3', 'A4')) x WHERE n <= 10""")
def neighbours(t):
    ids = t.spark.createDataFrame([("I1",), ("I50",), ("M3",), ("A4",)], "id string")
    return V.neighbours(t.edge, ids).select("id", "type", "other")


@query("J24_without_edges", "SELECT i.indicator_id FROM indicator i WHERE 'I' || i.indicator_id::VARCHAR NOT IN (SELECT src FROM edge WHERE trg = 'M1')")
def without_edges(t):
    rows = t.indicator.select("indicator_id", F.concat(F.lit("I"), F.col("indicator_id").cast("string")).alias("k"))
    return V.without_edges(rows, "k", t.edge.where(F.col("trg") == "M1")).select("indicator_id")


@query("Q3_zone_view", "SELECT cve_id, score FROM vulnerability WHERE list_contains(split(zones, ';'), 'energy') AND (severity IN ('HIGH', 'CRITICAL') OR score >= 7) ORDER BY score DESC NULLS FIRST, cve_id LIMIT 50")
def zone_view(t):
    rows = t.vulnerability.where(F.array_contains(F.split("zones", ";"), "energy") & V.severity_filter("high", F.col("severity"), F.col("score")))
    return V.page(rows.select("cve_id", "score"), "score", "cve_id", 50)


@query("Q4_Q14_indicators", "SELECT indicator_id, value, confidence, count(*) OVER () AS total FROM live WHERE active AND confidence >= 0.5 ORDER BY confidence DESC NULLS FIRST, indicator_id LIMIT 40")
def indicators(t):
    rows = t.live.where(F.coalesce("active", F.lit(True)) & (F.col("confidence") >= 0.5)).select("indicator_id", "value", "confidence")
    total = rows.agg(F.count("*").alias("total"))
    return V.page(rows, "confidence", "indicator_id", 40).join(F.broadcast(total))


@query("Q6_attack_view", "SELECT m.name AS malware, a.zone, count(DISTINCT a.indicator_id) AS indicators FROM attribute a JOIN malware m ON a.malware_id = m.malware_id GROUP BY m.name, a.zone")
def attack_view(t):
    return t.attribute.join(t.malware, "malware_id").groupBy(F.col("name").alias("malware"), "zone").agg(F.countDistinct("indicator_id").alias("indicators"))


@query("Q7_actor_view", """WITH a AS (SELECT actor_id, unnest(split(uses_techniques, ';')) AS mitre_id FROM (SELECT * FROM actor ORDER BY name LIMIT 10) x)
  SELECT DISTINCT actor_id, a.mitre_id, t.tactic_phases FROM a LEFT JOIN technique t ON t.mitre_id = a.mitre_id""")
def actor_view(t):
    some = t.actor.orderBy("name").limit(10).select("actor_id", F.explode(F.split("uses_techniques", ";")).alias("mitre_id"))
    return some.join(t.technique, "mitre_id", "left").select("actor_id", "mitre_id", "tactic_phases").distinct()


@query("Q19_sources_of_node", "SELECT indicator_id, string_agg(DISTINCT source_name, '|' ORDER BY source_name) AS sources, count(DISTINCT source_name) AS n FROM attribute GROUP BY indicator_id")
def sources_of_node(t):
    return t.attribute.groupBy("indicator_id").agg(F.array_sort(F.collect_set("source_name")).alias("s")).select("indicator_id", F.array_join("s", "|").alias("sources"), F.size("s").cast("long").alias("n"))


@query("Q21_recent_by_zone", "SELECT zone, count(DISTINCT indicator_id) AS nodes FROM attribute WHERE seen >= TIMESTAMP '2001-10-01' GROUP BY zone")
def recent_by_zone(t):
    return V.member_counts(t.attribute.where(F.col("seen") >= F.lit("2001-10-01").cast("timestamp")), F.array("zone"), "indicator_id", "zone")


_ID = "substr({0},1,8)||'-'||substr({0},9,4)||'-5'||substr({0},14,3)||'-'||substr('89ab', ((instr('0123456789abcdef', substr({0},17,1)) - 1) % 4 + 1)::INTEGER, 1)||substr({0},18,3)||'-'||substr({0},21,12)"


def _sha(text: str) -> str:
    from ..functions.ident import NAMESPACE

    return f"sha1(unhex('{NAMESPACE.replace('-', '')}') || encode({text}))"


@query("X7_relation_ids", f"""SELECT indicator_id, malware_id, 'relationship--' || {_ID.format('h')} AS id FROM (SELECT indicator_id, malware_id, {_sha("lower('relationship:' || s || '|indicates|' || t)")} AS h FROM (SELECT indicator_id, malware_id, 'indicator--' || {_ID.format('a')} AS s, 'malware--' || {_ID.format('b')} AS t FROM
  (SELECT i.indicator_id, m.malware_id, {_sha("'indicator:' || lower(indicator_type || '|' || value)")} AS a, {_sha("'malware:' || lower(m.name)")} AS b FROM indicates e JOIN indicator i ON e.indicator_id = i.indicator_id JOIN malware m ON m.malware_id = e.malware_id ) x) y) z""")
def relation_ids(t):
    """Ids of relations; those of their ends are made once a node."""
    src = t.indicator.select("indicator_id", X.stix_id("Indicator", [F.col("indicator_type"), F.col("value")]).alias("src"))
    trg = t.malware.select("malware_id", X.stix_id("Malware", [F.col("name")]).alias("trg"))
    rows = t.indicates.join(src, "indicator_id").join(trg, "malware_id")
    return rows.select("indicator_id", "malware_id", X.relation_id(F.lit("INDICATES"), F.col("src"), F.col("trg")).alias("id"))
