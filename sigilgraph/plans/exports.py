"""STIX exports of malware with all neighbours, and objects of names; those of the four export types are in bundling.py."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ident import NAMESPACE
from ..operators import stix as X
from .catalog import query

_UUID = "substr({0},1,8)||'-'||substr({0},9,4)||'-5'||substr({0},14,3)||'-'||substr('89ab', ((instr('0123456789abcdef', substr({0},17,1)) - 1) % 4 + 1)::INTEGER, 1)||substr({0},18,3)||'-'||substr({0},21,12)"
_SHA = f"sha1(unhex('{NAMESPACE.replace('-', '')}') || encode({{0}}))"
_IDS = f"""o AS (SELECT 'ThreatActor' AS label, name AS key, 'intrusion-set' AS kind FROM actor UNION ALL SELECT 'Malware', name, 'malware' FROM malware UNION ALL SELECT 'Technique', mitre_id, 'attack-pattern' FROM (SELECT DISTINCT mitre_id FROM technique) t
  UNION ALL SELECT 'Tool', name, 'tool' FROM tool UNION ALL SELECT 'Indicator', indicator_type || '|' || value, 'indicator' FROM indicator UNION ALL SELECT 'Vulnerability', cve_id, 'vulnerability' FROM (SELECT cve_id FROM vulnerability UNION SELECT cve_id FROM cve) v
  UNION ALL SELECT 'Sector', zone, 'identity' FROM (SELECT DISTINCT zone FROM attribute WHERE zone <> 'global') z),
h AS (SELECT *, {_SHA.format("kind || ':' || lower(key)")} AS h FROM o),
ids AS (SELECT label, key, kind, kind || '--' || {_UUID.format('h')} AS id FROM h)"""
_EDGES = """e AS (SELECT 'ATTRIBUTED_TO' AS type, 'Malware' AS sl, m.name AS sk, 'ThreatActor' AS tl, a.name AS tk FROM malware m JOIN actor a ON m.nationkey = a.actor_id
  UNION SELECT 'EMPLOYS_TECHNIQUE', 'ThreatActor', name, 'Technique', unnest(split(uses_techniques, ';')) FROM actor UNION SELECT 'IMPLEMENTS_TECHNIQUE', 'Malware', name, 'Technique', unnest(split(uses_techniques, ';')) FROM malware
  UNION SELECT 'IMPLEMENTS_TECHNIQUE', 'Tool', name, 'Technique', unnest(split(uses_techniques, ';')) FROM tool UNION SELECT 'USES_TECHNIQUE', 'Indicator', indicator_type || '|' || value, 'Technique', attack_id FROM indicator
  UNION SELECT 'EXPLOITS', 'Indicator', indicator_type || '|' || value, 'Vulnerability', cve_id FROM indicator WHERE cve_id IS NOT NULL
  UNION SELECT 'INDICATES', 'Indicator', indicator_type || '|' || value, 'Malware', m.name FROM indicates x JOIN indicator i ON i.indicator_id = x.indicator_id JOIN malware m ON m.malware_id = x.malware_id
  UNION SELECT 'TARGETS', 'Indicator', indicator_type || '|' || value, 'Sector', zone FROM attribute x JOIN indicator i ON i.indicator_id = x.indicator_id WHERE zone <> 'global')"""
_EXPORT = (
    "WITH " + _IDS + ",\n" + _EDGES + f""",
r AS (SELECT s.label AS sl, s.key AS sk, s.id AS sid, t.label AS tl, t.key AS tk, t.id AS tid, {_SHA.format("lower('relationship:' || s.id || '|' || replace(e.type, '_', '-') || '|' || t.id)")} AS h FROM e JOIN ids s ON s.label = e.sl AND s.key = e.sk JOIN ids t ON t.label = e.tl AND t.key = e.tk),
p AS (SELECT key AS seed, id FROM ids WHERE label = '$' UNION SELECT sk, tid FROM r WHERE sl = '$' UNION SELECT tk, sid FROM r WHERE tl = '$'
  UNION SELECT sk, 'relationship--' || {_UUID.format('h')} FROM r WHERE sl = '$' UNION SELECT tk, 'relationship--' || {_UUID.format('h')} FROM r WHERE tl = '$'),
g AS (SELECT seed, count(*)::INTEGER AS n_objects, {_SHA.format("sha256('[\"' || string_agg(id, '\",\"' ORDER BY id) || '\"]')")} AS h FROM p GROUP BY seed)
SELECT seed, n_objects, 'bundle--' || {_UUID.format('h')} AS bundle_id FROM g"""
)


def graph(t) -> tuple[DataFrame, DataFrame]:
    """Nodes (label, key, id) and edges (type, src_label, src_key, trg_label, trg_key) of the domain tables."""
    c = F.col
    value = [c("indicator_type"), c("value")]
    node = lambda df, label, fields: df.select(F.lit(label).alias("label"), F.concat_ws("|", *fields).alias("key"), X.stix_id(label, fields).alias("id"))
    cves = t.vulnerability.select("cve_id").unionByName(t.cve.select("cve_id")).distinct()
    sectors = t.attribute.where("zone <> 'global'").select("indicator_id", "zone").distinct()
    nodes = [node(t.actor, "ThreatActor", [c("name")]), node(t.malware, "Malware", [c("name")]), node(t.technique.select("mitre_id").distinct(), "Technique", [c("mitre_id")]), node(t.tool, "Tool", [c("name")]), node(t.indicator, "Indicator", value), node(cves, "Vulnerability", [c("cve_id")]), node(sectors.select("zone").distinct(), "Sector", [c("zone")])]
    edge = lambda df, kind, a, x, b, y: df.select(F.lit(kind).alias("type"), F.lit(a).alias("src_label"), x.alias("src_key"), F.lit(b).alias("trg_label"), y.alias("trg_key"))
    i = t.indicator.withColumn("ikey", F.concat_ws("|", *value))
    used = F.explode(F.split("uses_techniques", ";"))
    names = t.malware.select("malware_id", F.col("name").alias("mname"), F.col("nationkey").alias("actor_id"))
    edges = [
        edge(names.join(t.actor, "actor_id"), "ATTRIBUTED_TO", "Malware", c("mname"), "ThreatActor", c("name")),
        edge(t.actor, "EMPLOYS_TECHNIQUE", "ThreatActor", c("name"), "Technique", used), edge(t.malware, "IMPLEMENTS_TECHNIQUE", "Malware", c("name"), "Technique", used),
        edge(t.tool, "IMPLEMENTS_TECHNIQUE", "Tool", c("name"), "Technique", used), edge(i, "USES_TECHNIQUE", "Indicator", c("ikey"), "Technique", c("attack_id")),
        edge(i.where(c("cve_id").isNotNull()), "EXPLOITS", "Indicator", c("ikey"), "Vulnerability", c("cve_id")),
        edge(t.indicates.join(i, "indicator_id").join(names, "malware_id"), "INDICATES", "Indicator", c("ikey"), "Malware", c("mname")),
        edge(sectors.join(i, "indicator_id"), "TARGETS", "Indicator", c("ikey"), "Sector", c("zone")),
    ]
    return reduce(DataFrame.unionByName, nodes), reduce(DataFrame.unionByName, edges).distinct()


@query("X_malware_export", _EXPORT.replace("$", "Malware"))
def malware_export(t):
    nodes, edges = graph(t)
    return X.bundle_ids(X.neighbour_objects(nodes, edges, "Malware"), "seed")


@query("X6_objects", "WITH " + _IDS + """ SELECT label, key, '{"type":"' || kind || '","spec_version":"2.1","id":"' || id || '","name":"' || key || '"}' AS object FROM ids WHERE label <> 'Indicator'""")
def named_objects(t):
    """The objects of all labels that a name describes."""
    nodes, _ = graph(t)
    return nodes.where("label <> 'Indicator'").select("label", "key", X.object_of(F.col("label"), F.col("id"), F.col("key")).alias("object"))
