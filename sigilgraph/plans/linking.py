"""Queries of derived edges."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import link as L
from ..operators.enrich import bridge
from .catalog import query

_EDGE = ["src", "trg"]


@query("J1_in_tactic", "SELECT DISTINCT t.mitre_id AS src, c.mitre_id AS trg FROM (SELECT mitre_id, unnest(split(tactic_phases, ';')) AS phase FROM technique) t JOIN tactic c ON lower(t.phase) = lower(c.shortname)")
def in_tactic(t):
    phases = t.technique.select("mitre_id", F.explode(F.split("tactic_phases", ";")).alias("phase"))
    return L.link_exact(phases, F.lower("phase"), "mitre_id", t.tactic, F.lower("shortname"), "mitre_id", "IN_TACTIC", 1.0, "tactic").select(*_EDGE)


@query("J2_attributed_to", """SELECT DISTINCT m.malware_id AS src, a.actor_id AS trg FROM malware m JOIN (SELECT actor_id, lower(name) AS k FROM actor UNION ALL SELECT actor_id, lower(u) FROM (SELECT actor_id, unnest(split(aliases, ';')) AS u FROM actor) y) a ON lower(trim(m.attributed_to)) = a.k WHERE a.k <> 'unknown'
  UNION SELECT m.malware_id, a.actor_id FROM malware m JOIN actor a ON m.nation = lower(a.name)""")
def attributed(t):
    pairs = [(L.names_of(F.col("attributed_to")), L.names_of(F.col("name"))), (L.names_of(F.col("attributed_to")), L.names_of(F.split("aliases", ";"), lists=True)), (L.names_of(F.split("nation", ";"), lists=True), L.names_of(F.col("name")))]
    m = t.malware.select("malware_id", "attributed_to", "nation")
    return L.or_join(m, t.actor, pairs, [F.col("malware_id").alias("src"), F.col("actor_id").alias("trg")])


for _n, _label in (("J3a_exploits_vulnerability", "vulnerability"), ("J3b_exploits_cve", "cve")):

    @query(_n, f"SELECT i.indicator_id AS src, v.cve_id AS trg FROM indicator i JOIN {_label} v ON i.cve_id = v.cve_id")
    def exploits(t, label=_label):
        return L.link_exact(t.indicator, F.col("cve_id"), "indicator_id", getattr(t, label), F.col("cve_id"), "cve_id", "EXPLOITS", 1.0, "cve_tag").select(*_EDGE)


@query("J4_cooccurrence", """SELECT i.indicator_id AS src, m.malware_id AS trg, count(*) AS shared FROM (SELECT DISTINCT indicator_id, event_id FROM attribute) i
  JOIN (SELECT DISTINCT malware_id, event_id FROM attribute) m ON i.event_id = m.event_id GROUP BY i.indicator_id, m.malware_id""")
def cooccurrence(t):
    a = t.attribute
    return L.shared_members(a.select(F.col("indicator_id").alias("src"), "event_id"), a.select(F.col("malware_id").alias("trg"), "event_id"), "event_id")


@query("J5_J6_J10_uses", "SELECT DISTINCT a.actor_id AS src, t.mitre_id AS trg FROM (SELECT actor_id, unnest(split(uses_techniques, ';')) AS k FROM actor) a JOIN technique t ON a.k = t.mitre_id")
def uses(t):
    return L.link_exact(t.actor, F.explode(F.split("uses_techniques", ";")), "actor_id", t.technique, F.col("mitre_id"), "mitre_id", "EMPLOYS_TECHNIQUE", 0.95, "mitre_explicit").select(*_EDGE)


@query("J7_targets", "SELECT DISTINCT indicator_id AS src, zone AS trg FROM attribute WHERE zone IN ('global', 'healthcare', 'energy', 'finance')")
def targets(t):
    sectors = t.spark.createDataFrame([(z,) for z in ("global", "healthcare", "energy", "finance")], "name string")
    return L.link_exact(t.attribute, F.col("zone"), "indicator_id", sectors, F.col("name"), "name", "TARGETS", 0.5, "zone").select(*_EDGE)


@query("J8_uses_technique", "SELECT DISTINCT i.indicator_id AS src, t.mitre_id AS trg FROM indicator i JOIN technique t ON i.attack_id = t.mitre_id")
def indicator_uses(t):
    return L.link_exact(t.indicator, F.col("attack_id"), "indicator_id", t.technique, F.col("mitre_id"), "mitre_id", "USES_TECHNIQUE", 0.85, "otx_attack_ids").select(*_EDGE)


@query("J9_family", """SELECT DISTINCT i.indicator_id AS src, m.malware_id AS trg FROM indicator i JOIN (SELECT malware_id, lower(trim(name)) AS k FROM malware UNION ALL SELECT malware_id, lower(trim(family)) FROM malware UNION ALL SELECT malware_id, lower(trim(u)) FROM (SELECT malware_id, unnest(split(aliases, ';')) AS u FROM malware) y) m
  ON lower(i.malware_family) = m.k WHERE i.malware_family <> 'unknown'""")
def family(t):
    key = L.names_of(F.col("malware_family"))
    mal = t.malware.select("malware_id", "family", F.col("name").alias("mname"), F.split("aliases", ";").alias("also"))
    pairs = [(key, L.names_of(F.col("mname"))), (key, L.names_of(F.col("family"))), (key, L.names_of(F.col("also"), lists=True))]
    return L.or_join(t.indicator, mal, pairs, [F.col("indicator_id").alias("src"), F.col("malware_id").alias("trg")])


@query("J12_E1_bridge", "SELECT 'Vulnerability' AS src_label, 'CVE' AS trg_label, v.cve_id FROM vulnerability v JOIN cve c ON v.cve_id = c.cve_id UNION ALL SELECT 'CVE', 'Vulnerability', v.cve_id FROM vulnerability v JOIN cve c ON v.cve_id = c.cve_id")
def bridges(t):
    return bridge(t.vulnerability, t.cve)


@query("J13_actors_with_malware", "SELECT actor_id FROM actor WHERE actor_id IN (SELECT nationkey FROM malware)")
def actors_with_malware(t):
    return t.actor.join(t.malware.select(F.col("nationkey").alias("actor_id")), "actor_id", "left_semi").select("actor_id")


@query("J19_scores", "SELECT coalesce(v.cve_id, c.cve_id) AS cve_id, coalesce(v.score, c.score) AS score FROM vulnerability v FULL JOIN cve c ON v.cve_id = c.cve_id")
def scores(t):
    from ..operators.serve import effective_score

    c = t.cve.select("cve_id", F.col("score").alias("s31"))
    none = F.lit(None).cast("double")
    return t.vulnerability.join(c, "cve_id", "full").select("cve_id", effective_score(F.col("score"), F.col("s31"), none, none, none).alias("score"))


@query("J23_shared_events", "SELECT b.indicator_id, count(DISTINCT b.event_id) AS shared FROM indicator_event a JOIN indicator_event b ON a.event_id = b.event_id AND a.indicator_id = 10 AND b.indicator_id <> 10 GROUP BY b.indicator_id")
def shared_events(t):
    e = t.indicator_event
    known = e.where("indicator_id = 10").select("event_id")
    return e.where("indicator_id <> 10").join(known, "event_id", "left_semi").groupBy("indicator_id").agg(F.count("*").alias("shared"))


@query("R1_event_relations", "SELECT 'ATTRIBUTED_TO' AS type, i.malware_id AS src, j.zone AS trg, count(DISTINCT i.event_id) AS events FROM attribute i JOIN attribute j ON i.event_id = j.event_id WHERE j.zone <> 'global' GROUP BY i.malware_id, j.zone")
def event_relations(t):
    a = t.attribute
    items = {"malware": a.select("event_id", F.col("malware_id").alias("key")), "sector": a.where("zone <> 'global'").select("event_id", F.col("zone").alias("key"))}
    return L.event_relations(items, [("ATTRIBUTED_TO", "malware", "sector")]).select("type", F.col("src").cast("long").alias("src"), "trg", "events")


@query("R2_capped", "SELECT event_id, idx FROM (SELECT event_id, idx, row_number() OVER (PARTITION BY event_id ORDER BY idx) AS n FROM attribute) x WHERE n <= 2")
def capped(t):
    return L.capped(t.attribute.select("event_id", "idx"), ["event_id"], ["idx"], 2)


@query("R2_caps", """WITH c AS (SELECT malware_id AS event_id, least(count(DISTINCT indicator_id), 2000)::DOUBLE AS i, least(count(DISTINCT event_id), 500)::DOUBLE AS m FROM attribute GROUP BY malware_id),
  s AS (SELECT *, CASE WHEN i * m > 50000 THEN sqrt(50000e0 / (i * m)) ELSE 1e0 END AS f FROM c)
  SELECT event_id, 'indicator' AS kind, least(i, greatest(floor(i * f), 100))::INTEGER AS cap FROM s UNION ALL SELECT event_id, 'malware', least(m, greatest(floor(m * f), 50))::INTEGER FROM s""")
def caps(t):
    n = t.attribute.groupBy(F.col("malware_id").alias("event_id")).agg(F.countDistinct("indicator_id").alias("i"), F.countDistinct("event_id").alias("m"))
    counts = n.select("event_id", F.lit("indicator").alias("kind"), F.col("i").alias("n")).unionByName(n.select("event_id", F.lit("malware").alias("kind"), F.col("m").alias("n")))
    return L.event_caps(counts, {"indicator": 2000, "malware": 500}, floors={"indicator": 100, "malware": 50})


@query("TOPOLOGY_link", "SELECT DISTINCT l_suppkey AS src, l_partkey AS trg, 'ON' AS type FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 10) AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25)")
def topology(t):
    edges = t.lineitem.select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("trg"))
    return L.link_topology(edges, t.supplier.where("s_nationkey < 10"), "s_suppkey", t.part.where("p_size > 25"), "p_partkey", "ON")
