"""Queries of relation definitions: what tags of staging attributes say, resolved against the nodes in all eleven groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dispatch as D
from .catalog import query

c = F.col
_SOURCE = "CASE a.source_name WHEN 'AlienVault-OTX' THEN 'alienvault_otx' WHEN 'NVD' THEN 'nvd' WHEN 'CISA-KEV' THEN 'cisa_kev' WHEN 'URLhaus' THEN 'urlhaus' ELSE 'misp' END"
_DEFS = f"""a0 AS (SELECT a.event_id, a.idx, a.indicator_id, a.zone, {_SOURCE} AS source, CASE WHEN a.idx % 2 = 0 THEN 0.8e0 ELSE 0.5e0 END AS conf, m.name AS mal, m.nation, a.event_id * 1000 + a.idx AS seq FROM attribute a JOIN malware m ON m.malware_id = a.malware_id),
i0 AS (SELECT *, CASE idx WHEN 1 THEN '10.0.0.' ELSE 'h' END || (indicator_id % 250)::VARCHAR AS value, CASE idx WHEN 1 THEN 'ipv4' ELSE 'domain' END AS kind FROM a0 WHERE idx <= 2),
defs AS (SELECT 'INDICATES' AS rel, 'Indicator' AS frm, value AS sk, lower(mal) AS tk, conf, source, event_id::VARCHAR AS ev, seq FROM i0
  UNION ALL SELECT 'TARGETS', 'Indicator', value, zone, conf, source, event_id::VARCHAR, seq FROM i0 WHERE zone <> 'global'
  UNION ALL SELECT 'EXPLOITS', 'Indicator', value, 'CVE-2024-' || indicator_id::VARCHAR, greatest(conf, 0.7e0), source, event_id::VARCHAR, seq FROM i0 WHERE event_id % 2 = 0
  UNION ALL SELECT 'EMPLOYS_TECHNIQUE', 'ThreatActor', CASE WHEN indicator_id % 2 = 1 THEN 'alias-' ELSE '' END || nation, 'T' || (1000 + indicator_id % 60)::VARCHAR, conf, source, event_id::VARCHAR, seq FROM a0 WHERE idx = 3
  UNION ALL SELECT 'ATTRIBUTED_TO', 'Malware', lower(mal), nation, conf, source, event_id::VARCHAR, seq FROM a0 WHERE idx = 4
  UNION ALL SELECT 'AFFECTS', 'Vulnerability', 'CVE-2024-' || indicator_id::VARCHAR, zone, conf, source, event_id::VARCHAR, seq FROM a0 WHERE idx = 5 AND zone <> 'global'
  UNION ALL SELECT 'TARGETS', 'Tool', 'S', zone, conf, source, event_id::VARCHAR, seq FROM a0 WHERE idx = 6 AND zone <> 'global')"""
_ALL = _DEFS + """, alld AS (SELECT * FROM defs
  UNION ALL SELECT 'IMPLEMENTS_TECHNIQUE', 'Malware', lower(name), unnest(split(uses_techniques, ';')), 0.5e0, 'mitre', NULL, 0 FROM malware
  UNION ALL SELECT 'IMPLEMENTS_TECHNIQUE', 'Tool', 'S' || (1000 + tool_id % 20)::VARCHAR, unnest(split(uses_techniques, ';')), 0.5e0, 'mitre', NULL, 0 FROM tool
  UNION ALL SELECT 'IMPLEMENTS_TECHNIQUE', NULL, lower(name), 'T1000', 0.5e0, 'mitre', NULL, 0 FROM actor
  UNION ALL SELECT 'EMPLOYS_TECHNIQUE', 'Campaign', lower(name) || ' campaign', unnest(split(uses_techniques, ';')), 0.5e0, 'mitre', NULL, 0 FROM actor
  UNION ALL SELECT 'ATTRIBUTED_TO', 'Malware', lower(name), CASE WHEN malware_id % 7 <> 0 THEN lower(trim(attributed_to)) END, 0.5e0, 'mitre', NULL, 0 FROM malware),
idx AS (SELECT DISTINCT 'Indicator' AS label, '10.0.0.' || k::VARCHAR AS key, 'Indicator:ipv4|10.0.0.' || k::VARCHAR AS id FROM (SELECT p_partkey % 200 AS k FROM part) x UNION SELECT DISTINCT 'Indicator', 'h' || k::VARCHAR, 'Indicator:domain|h' || k::VARCHAR FROM (SELECT p_partkey % 200 AS k FROM part) x
  UNION SELECT DISTINCT 'Indicator', 'h' || k::VARCHAR, 'Indicator:hostname|h' || k::VARCHAR FROM (SELECT p_partkey % 100 AS k FROM part) x UNION SELECT 'Malware', lower(name), 'Malware:' || lower(name) FROM malware
  UNION SELECT 'ThreatActor', lower(name), 'ThreatActor:' || lower(name) FROM actor UNION SELECT 'ThreatActor', 'alias-' || lower(name), 'ThreatActor:' || lower(name) FROM actor UNION SELECT 'Campaign', lower(name) || ' campaign', 'Campaign:' || lower(name) || ' campaign' FROM actor WHERE actor_id % 5 > 0
  UNION SELECT 'Technique', mitre_id, 'Technique:' || mitre_id FROM technique UNION SELECT DISTINCT 'Tool', 'S' || (1000 + tool_id % 15)::VARCHAR, 'Tool:S' || (1000 + tool_id % 15)::VARCHAR FROM tool
  UNION SELECT 'Vulnerability', cve_id, 'Vulnerability:' || cve_id FROM vulnerability UNION SELECT 'CVE', cve_id, 'CVE:' || cve_id FROM cve UNION SELECT DISTINCT 'Sector', zone, 'Sector:' || zone FROM attribute),
routes AS (SELECT * FROM (VALUES ('EMPLOYS_TECHNIQUE_actor', 'EMPLOYS_TECHNIQUE', 'ThreatActor', 'ThreatActor', 'Technique'), ('EMPLOYS_TECHNIQUE_campaign', 'EMPLOYS_TECHNIQUE', 'Campaign', 'Campaign', 'Technique'), ('IMPLEMENTS_TECHNIQUE_malware', 'IMPLEMENTS_TECHNIQUE', 'Malware', 'Malware', 'Technique'),
  ('IMPLEMENTS_TECHNIQUE_tool', 'IMPLEMENTS_TECHNIQUE', 'Tool', 'Tool', 'Technique'), ('ATTRIBUTED_TO', 'ATTRIBUTED_TO', 'Malware', 'Malware', 'ThreatActor'), ('INDICATES_malware', 'INDICATES', 'Indicator', 'Indicator', 'Malware'), ('TARGETS_indicator', 'TARGETS', 'Indicator', 'Indicator', 'Sector'),
  ('AFFECTS_vulnerability', 'AFFECTS', 'Vulnerability', 'Vulnerability', 'Sector'), ('AFFECTS_cve', 'AFFECTS', 'Vulnerability', 'CVE', 'Sector'), ('EXPLOITS_vulnerability', 'EXPLOITS', 'Indicator', 'Indicator', 'Vulnerability'), ('EXPLOITS_cve', 'EXPLOITS', 'Indicator', 'Indicator', 'CVE')) r(grp, rel, frm, sl, tl)),
rt AS (SELECT d.*, r.grp, r.sl, r.tl FROM alld d LEFT JOIN routes r ON r.rel = d.rel AND r.frm = d.frm),
res AS (SELECT rt.*, s.id AS src, t.id AS trg FROM rt JOIN idx s ON s.label = rt.sl AND s.key = rt.sk JOIN idx t ON t.label = rt.tl AND t.key = rt.tk)"""


def attributes(t) -> DataFrame:
    """Staging attributes of seven types with the tags that name what they relate to."""
    k, n = c("idx"), c("indicator_id")
    rows = t.attribute.join(t.malware.select("malware_id", c("name").alias("mal"), "nation"), "malware_id")
    pick = lambda *xs: reduce(lambda a, x: a.when(k == x[0], x[1]), xs[1:], F.when(k == xs[0][0], xs[0][1]))
    part = (n % 250).cast("string")
    kind = pick((1, "ip-dst"), (2, "hostname"), (3, "threat-actor"), (4, "malware-type"), (5, "vulnerability"), (6, "text"), (7, "url"))
    value = pick((1, F.concat(F.lit("10.0.0."), part)), (2, F.concat(F.lit(" H"), part)), (3, F.when(n % 2 == 1, F.concat(F.lit("Alias-"), F.upper("nation"))).otherwise(c("nation"))), (4, c("mal")), (5, F.concat(F.lit("cve-2024-"), n.cast("string"))), (6, F.concat(F.lit("S"), (n % 20 + 1000).cast("string"), F.lit(": Tool"))), (7, F.lit("  ")))
    tags = F.array(F.concat(F.lit("source:"), "source_name"), F.when(k % 2 == 0, "confidence:high").otherwise("confidence:odd"), F.when(c("zone") != "global", F.concat(F.lit("sector: "), F.upper("zone"))).otherwise("tlp:white"), F.concat(F.lit("malware-type: "), F.upper("mal")),
                   F.when(c("event_id") % 2 == 0, F.concat(F.lit("exploits: cve-2024-"), n.cast("string"))).otherwise("exploits: none"), F.concat(F.lit("threat-actor:"), "nation"), F.concat(F.lit("mitre-attack:technique:T"), (n % 60 + 1000).cast("string")))
    return rows.select("event_id", "idx", kind.alias("attr_type"), value.alias("value"), tags.alias("tags"))


def definitions(t) -> DataFrame:
    """Those of attributes, and of tables of malware, tools and actors; some without a type or an end."""
    null, key = F.lit(None).cast("string"), lambda **f: F.map_from_arrays(F.array(*[F.lit(k) for k in f]), F.array(*f.values()))
    used = F.explode(F.split("uses_techniques", ";"))

    def told(df, rel, frm, src, trg):
        rows = df.select(rel.alias("rel_type"), frm.alias("from_type"), src.alias("from_key"), F.lit("Any").alias("to_type"), trg.alias("to_key"))
        return rows.select("*", F.lit(0.5).alias("confidence"), F.lit("mitre").alias("source"), null.alias("event_id"), F.lit(0).cast("long").alias("seq"))

    tech = lambda df: df.withColumn("tech", used)
    name, mitre, to_tech = key(name=c("name")), key(mitre_id=F.concat(F.lit("s"), (c("tool_id") % 20 + 1000).cast("string"))), key(mitre_id=F.lower("tech"))
    implements, employs = F.lit("IMPLEMENTS_TECHNIQUE"), F.lit("EMPLOYS_TECHNIQUE")
    parts = [
        told(tech(t.malware), implements, F.lit("Malware"), name, to_tech), told(tech(t.tool), implements, F.lit("Tool"), mitre, to_tech), told(t.actor, implements, null, name, key(mitre_id=F.lit("T1000"))),
        told(tech(t.actor), employs, F.lit("Campaign"), key(name=F.concat("name", F.lit(" Campaign "))), to_tech),
        told(t.malware, F.lit("ATTRIBUTED_TO"), F.lit("Malware"), name, key(name=F.when(c("malware_id") % 7 != 0, c("attributed_to")).otherwise(" "))),
    ]
    return reduce(DataFrame.unionByName, [D.embedded(attributes(t)), *parts])


def index(t) -> DataFrame:
    none, kind = F.array().cast("array<string>"), F.lit(None).cast("string")

    def nodes(df, label, key, aliases=none, kind=kind):
        shown = F.concat_ws("|", kind, D.canonical(F.lit(label), kind, key))
        return df.select(F.lit(label).alias("label"), F.concat(F.lit(label + ":"), shown).alias("id"), kind.alias("kind"), key.alias("key"), aliases.alias("aliases"))

    one = lambda prefix, n: F.concat(F.lit(prefix), (c("p_partkey") % n).cast("string"))
    parts = [
        *[nodes(t.part.select(one(p, n).alias("v")).distinct(), "Indicator", c("v"), kind=F.lit(k)) for p, n, k in (("10.0.0.", 200, "ipv4"), ("H", 200, "domain"), ("h", 100, "hostname"))],
        nodes(t.malware, "Malware", c("name"), F.split("aliases", ";")), nodes(t.actor, "ThreatActor", c("name"), F.split("aliases", ";")), nodes(t.actor.where("actor_id % 5 > 0"), "Campaign", F.concat("name", F.lit(" Campaign"))),
        nodes(t.technique.select("mitre_id").distinct(), "Technique", c("mitre_id")), nodes(t.tool.select(F.concat(F.lit("S"), (c("tool_id") % 15 + 1000).cast("string")).alias("v")).distinct(), "Tool", c("v")),
        nodes(t.vulnerability, "Vulnerability", c("cve_id")), nodes(t.cve, "CVE", c("cve_id")),
    ]
    return D.endpoint_index(reduce(DataFrame.unionByName, parts))


@query("P10_embedded_relations", f"WITH {_DEFS} SELECT rel AS rel_type, frm AS from_type, CASE WHEN rel = 'TARGETS' AND frm = 'Tool' THEN 'S' ELSE sk END AS src, lower(tk) AS trg, conf AS confidence, source, ev AS event_id, seq FROM defs")
def embedded(t):
    src = F.coalesce(*[c("from_key")[k] for k in ("value", "name", "cve_id")], F.left(c("from_key")["mitre_id"], F.lit(1)))
    trg = F.lower(F.coalesce(*[c("to_key")[k] for k in ("name", "mitre_id", "cve_id")]))
    folded = F.when(c("from_type").isin("ThreatActor", "Malware") | (c("from_key")["indicator_type"] == "domain"), F.lower(src)).otherwise(src)
    return D.embedded(attributes(t)).select("rel_type", "from_type", folded.alias("src"), trg.alias("trg"), "confidence", "source", "event_id", "seq")


@query("M8_J17_J18_dispatch", f"""WITH {_ALL}, e AS (SELECT rel AS type, src, trg, arg_max(conf, (seq, conf)) AS confidence, list_sort(list_distinct(list(source))) AS s, count(DISTINCT ev) AS events FROM res GROUP BY rel, src, trg)
  SELECT type, src, trg, confidence, CASE WHEN type = 'EXPLOITS' THEN 'cve_tag' ELSE 'tag' END AS match_type, array_to_string(s, '|') AS sources, events FROM e""")
def dispatched(t):
    d = D.Dispatch(definitions(t), index(t))
    n = d.members.groupBy("type", "src", "trg").agg(F.count("*").alias("events"))
    e = d.edges.join(n, ["type", "src", "trg"], "left")
    return e.select("type", "src", "trg", "confidence", "match_type", F.array_join("sources", "|").alias("sources"), F.coalesce("events", F.lit(0)).cast("long").alias("events"))


@query("M8_dispatch_report", f"""WITH {_ALL}, d AS (SELECT coalesce(grp, 'no route: ' || rel) AS grp, count(*) AS definitions, count(*) FILTER (grp IS NULL OR tk IS NULL) AS dropped FROM rt GROUP BY 1),
  p AS (SELECT grp, sk, tk, count(DISTINCT (src, trg)) AS made FROM res GROUP BY grp, sk, tk), e AS (SELECT grp, count(DISTINCT (src, trg)) AS edges FROM res GROUP BY grp),
  u AS (SELECT rt.grp, count(*) FILTER (p.made IS NULL) AS unresolved, max(coalesce(p.made, 0)) AS most FROM rt LEFT JOIN p ON p.grp = rt.grp AND p.sk = rt.sk AND p.tk = rt.tk WHERE rt.grp IS NOT NULL AND rt.tk IS NOT NULL GROUP BY rt.grp)
  SELECT d.grp, definitions, dropped, coalesce(unresolved, 0) AS unresolved, coalesce(edges, 0) AS edges, coalesce(most, 0) AS most FROM d LEFT JOIN u ON u.grp = d.grp LEFT JOIN e ON e.grp = d.grp""")
def dispatch_report(t):
    return D.Dispatch(definitions(t), index(t)).report
