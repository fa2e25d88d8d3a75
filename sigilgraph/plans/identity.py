"""Queries of identity, scalar and tag expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ident as I
from ..functions import scalars as S
from ..functions import tags as G
from .catalog import query

NS = I.NAMESPACE.replace("-", "")
_UUID = "substr(h,1,8)||'-'||substr(h,9,4)||'-5'||substr(h,14,3)||'-'||substr('89ab', ((instr('0123456789abcdef', substr(h,17,1)) - 1) % 4 + 1)::INTEGER, 1)||substr(h,18,3)||'-'||substr(h,21,12)"


@query("F20_uuid5", f"SELECT indicator_id, {_UUID} AS uuid FROM (SELECT indicator_id, sha1(unhex('{NS}') || encode('indicator:' || lower(indicator_type || '|' || value))) AS h FROM indicator) x")
def uuids(t):
    return t.indicator.select("indicator_id", I.node_uuid("Indicator", [F.col("indicator_type"), F.col("value")]).alias("uuid"))


@query("P15_merge_keys", """SELECT indicator_id, CASE WHEN indicator_type IN ('ipv4','domain','sha1') THEN lower(value) ELSE value END AS merge_value, coalesce(lower(trim(malware_family)) = 'unknown', true) AS placeholder FROM indicator""")
def merge_keys(t):
    return t.indicator.select("indicator_id", I.merge_value(F.col("indicator_type"), F.col("value")).alias("merge_value"), I.is_placeholder(F.col("malware_family")).alias("placeholder"))


_ODD = "CASE CAST(l_orderkey % 6 AS INTEGER) WHEN 0 THEN 'NaN' WHEN 1 THEN '1e309' WHEN 2 THEN 'high' WHEN 3 THEN NULL ELSE CAST(l_quantity AS VARCHAR(20)) END"


@query("P12_P13_clamps", f"""SELECT l_orderkey, l_linenumber, CASE WHEN NOT isnan(x) AND x BETWEEN 0 AND 10 THEN x END AS cvss, CASE WHEN NOT isnan(x / 20) AND x / 20 BETWEEN 0 AND 1 THEN x / 20 ELSE 0.5e0 END AS confidence
  FROM (SELECT l_orderkey, l_linenumber, TRY_CAST({_ODD} AS DOUBLE) AS x FROM lineitem) s""")
def clamps(t):
    odd = F.expr(_ODD)
    return t.lineitem.select("l_orderkey", "l_linenumber", S.clamp_cvss(odd).alias("cvss"), S.clamp_confidence(odd.try_cast("double") / 20).alias("confidence"))


@query("P16_P17_time", """SELECT o_orderkey, coalesce(strftime(ts, '%Y-%m-%d'), 'none') AS reported FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL WHEN o_orderkey % 4 = 0 AND o_orderdate::DATE < DATE '1995-01-01' THEN NULL
  WHEN o_orderkey % 4 = 0 THEN least(o_orderdate::DATE::TIMESTAMP, TIMESTAMP '1998-01-01') WHEN o_orderdate < TIMESTAMP '1995-01-01' THEN NULL ELSE least(o_orderdate, TIMESTAMP '1998-01-01') END AS ts FROM orders) x""")
def times(t):
    kind = F.col("o_orderkey") % 4
    text = F.when(kind == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(kind == 1, F.unix_timestamp("o_orderdate").cast("string")).when(kind == 2, S.stix_time(F.col("o_orderdate"))).otherwise("2024-13-45")
    return t.orders.select("o_orderkey", F.coalesce(F.date_format(S.plausible(S.iso_time(text), F.lit("1998-01-01").cast("timestamp")), "yyyy-MM-dd"), F.lit("none")).alias("reported"))


@query("P1_P5_tags", """WITH s AS (SELECT event_id, idx, split(tags, ';') AS t FROM tagged),
  z AS (SELECT event_id, idx, t, list_sort(list_distinct(list_filter(list_transform(list_filter(t, lambda x: regexp_matches(x, '^(zone|sector):')), lambda x: lower(trim(regexp_replace(x, '^(zone|sector):', '')))), lambda x: x IN ('global','healthcare','energy','finance')))) AS zs,
    list_filter(t, lambda x: x IN ('confidence:high','confidence:medium','confidence:low'))[-1] AS c, list_filter(t, lambda x: x LIKE 'severity:%' OR x LIKE 'cvss:%')[-1] AS v, list_filter(t, lambda x: x LIKE 'cvss:%')[-1] AS cv FROM s)
  SELECT event_id, idx, CASE substr(t[1], 8) WHEN 'AlienVault-OTX' THEN 'alienvault_otx' WHEN 'NVD' THEN 'nvd' WHEN 'CISA-KEV' THEN 'cisa_kev' WHEN 'URLhaus' THEN 'urlhaus' ELSE 'misp' END AS source,
  CASE WHEN len(zs) > 0 THEN array_to_string(zs, '|') ELSE 'global' END AS zones, CASE c WHEN 'confidence:high' THEN 0.8e0 WHEN 'confidence:low' THEN 0.3e0 ELSE 0.5e0 END AS confidence,
  coalesce(upper(regexp_replace(v, '^(severity|cvss):', '')), 'UNKNOWN') AS severity, CASE cv WHEN 'cvss:critical' THEN 9.0e0 WHEN 'cvss:low' THEN 3.0e0 END AS score FROM z""")
def tag_values(t):
    tags = F.split("tags", ";")
    return t.tagged.select("event_id", "idx", G.source_of(tags).alias("source"), F.array_join(G.zones_of(tags), "|").alias("zones"), G.confidence_of(tags).alias("confidence"), G.severity_of(tags).alias("severity"), G.tag_score(tags).alias("score"))


@query("P8_extraction", """SELECT event_id, idx, CASE idx WHEN 6 THEN 'Big Bear' END AS actor, CASE idx WHEN 7 THEN 'Worm|Trick Bot' ELSE '' END AS malware, CASE WHEN idx % 5 = 0 THEN 'CVE-2024-1' ELSE '' END AS cves FROM tagged""")
def extraction(t):
    tags = F.split("tags", ";")
    return t.tagged.select("event_id", "idx", G.actor_of(tags).alias("actor"), F.array_join(G.malware_of(tags), "|").alias("malware"), F.array_join(G.exploits_of(tags), "|").alias("cves"))


@query("P3_zone_resolution", """WITH o AS (SELECT event_id, idx, zone FROM attribute), e AS (SELECT event_id, list_distinct(list(zone)) AS ez FROM attribute GROUP BY event_id),
  u AS (SELECT o.event_id, o.idx, zone, list_distinct(list_append(ez, zone)) AS b FROM o JOIN e ON o.event_id = e.event_id)
  SELECT event_id, idx, CASE WHEN zone <> 'global' THEN zone WHEN len(list_filter(b, lambda x: x <> 'global')) > 0 THEN array_to_string(list_sort(list_filter(b, lambda x: x <> 'global')), '|') ELSE 'global' END AS zones FROM u""")
def zone_resolution(t):
    a = t.attribute
    per_event = a.groupBy("event_id").agg(F.collect_set("zone").alias("ez"))
    return a.join(per_event, "event_id").select("event_id", "idx", F.array_join(G.resolve_zones(F.array("zone"), F.col("ez")), "|").alias("zones"))


@query("P7_type_inference", """SELECT k, CASE k WHEN 0 THEN 'ip-dst' WHEN 1 THEN 'md5' WHEN 2 THEN 'vulnerability' WHEN 3 THEN 'url' WHEN 4 THEN 'email-src' WHEN 5 THEN 'domain' WHEN 6 THEN 'text' ELSE 'sha1' END AS kind, count(*) AS n
  FROM (SELECT p_partkey % 8 AS k FROM part) x GROUP BY k""")
def type_inference(t):
    k, s = F.col("p_partkey") % 8, F.col("p_partkey").cast("string")
    value = F.when(k == 0, F.concat(F.lit("10.0.0."), (F.col("p_partkey") % 256).cast("string"))).when(k == 1, F.md5(s)).when(k == 2, F.concat(F.lit("CVE-2024-"), s)).when(k == 3, F.concat(F.lit("HTTP://x.org/"), s))
    value = value.when(k == 4, F.concat(s, F.lit("@x.org"))).when(k == 5, F.concat(F.lit("h"), s, F.lit(".org"))).when(k == 6, F.concat(F.lit("word"), s)).otherwise(F.sha1(s))
    return t.part.select(k.alias("k"), S.infer_type(value).alias("kind")).groupBy("k", "kind").agg(F.count("*").alias("n"))


@query("S12_verdicts", """SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 0.5e0 ELSE round(least(0.95e0, 0.5e0 + 0.45e0 * ((p_partkey % 5) + 0.5e0 * (p_partkey % 3)) / 7), 2) END AS confidence FROM part""")
def verdicts(t):
    return t.part.select("p_partkey", S.verdict_confidence(F.col("p_partkey") % 5, F.col("p_partkey") % 3, (F.col("p_size") % 2) * 7).alias("confidence"))


@query("S4_known_exploited", """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'CRITICAL' WHEN 1 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, CASE p_partkey % 3 WHEN 0 THEN 9.0e0 WHEN 1 THEN 7.0e0 ELSE 5.0e0 END AS score FROM part""")
def exploited(t):
    severity, score = S.ransomware_severity(F.when(F.col("p_partkey") % 3 == 0, "Known").when(F.col("p_partkey") % 3 == 1, "Unknown"))
    return t.part.select("p_partkey", severity.alias("severity"), score.alias("score"))


@query("P22_patterns", """SELECT indicator_id, CASE indicator_type WHEN 'ipv4' THEN '[ipv4-addr:value = ''' || v || ''']' WHEN 'domain' THEN '[domain-name:value = ''' || v || ''']' WHEN 'url' THEN '[url:value = ''' || v || ''']' WHEN 'sha1' THEN '[file:hashes.''SHA1'' = ''' || v || ''']'
  ELSE '[email-addr:value = ''' || v || ''']' END AS pattern, o AS value FROM (SELECT indicator_id, indicator_type, value || '''s' AS o, value || '\\''s' AS v FROM indicator) x""")
def patterns(t):
    value = F.concat("value", F.lit("'s"))
    p = S.stix_pattern(F.col("indicator_type"), value)
    return t.indicator.select("indicator_id", p.alias("pattern"), S.pattern_value(p).alias("value"))


@query("F21_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_values(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))
