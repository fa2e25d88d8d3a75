"""Queries through the feed readers: a table is written as raw records of a feed, read back by its reader, and held against SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import tags as G
from ..functions import zones as Z
from ..functions.ident import is_placeholder
from ..operators import merge as M
from ..operators import parse as P
from ..operators import serve as V
from ..operators import stix
from ..session import scratch_path
from ..sources import feeds
from .catalog import query


def _text(t, rows: DataFrame) -> str:
    """Path of the rows (one text column) as lines of text, packed: raw records are many times as long as the columns they are made from. A packed
    file is read by one task, so files are kept small."""
    path = scratch_path(t.spark, "feed")
    rows.write.option("maxRecordsPerFile", 50_000).text(path, compression="gzip")
    return path


def _json(t, *parts: DataFrame) -> str:
    return _text(t, reduce(DataFrame.unionByName, [p.select(F.to_json(F.struct("*")).alias("value")) for p in parts]))


def _csv(t, rows: DataFrame, *cells) -> str:
    """Path of the rows as CSV below a comment."""
    quoted = [F.concat(F.lit('"'), F.coalesce(c.cast("string"), F.lit("")), F.lit('"')) for c in cells]
    head = t.spark.createDataFrame([("# first line",)], "value string")
    return _text(t, head.unionByName(rows.select(F.concat_ws(",", *quoted).alias("value"))))


def _s(c):
    return F.col(c).cast("string")


@query("S1_pulses", """WITH l AS (SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem), o AS (SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM l)),
  x AS (SELECT l_orderkey AS pulse, CASE WHEN l_linenumber = 1 THEN 'vulnerability' ELSE 'indicator' END AS kind, CASE WHEN l_linenumber = 1 THEN 'cve' ELSE 'ipv4' END AS indicator_type, CASE WHEN l_linenumber = 1 THEN 'CVE-2024-' ELSE 'val-' END || l_partkey::VARCHAR AS value FROM l
  UNION ALL SELECT o_orderkey, 'malware', NULL, 'M' || o_orderpriority FROM o UNION ALL SELECT o_orderkey, 'actor', NULL, 'Actor ' || o_orderstatus FROM o WHERE o_orderstatus <> 'O')
  SELECT x.pulse::VARCHAR AS pulse, kind, indicator_type, value, epoch(date_trunc('day', o_orderdate))::BIGINT AS seen, 'alienvault_otx' AS source FROM x JOIN o ON x.pulse = o.o_orderkey""")
def pulses(t):
    first = F.col("l_linenumber") == 1
    ind = F.struct(F.when(first, "CVE").otherwise("IPv4").alias("type"), F.concat(F.when(first, "cve-2024-").otherwise("val-"), _s("l_partkey")).alias("indicator"))
    lists = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(ind).alias("indicators"))
    adversary = F.when(F.col("o_orderstatus") == "O", " ").otherwise(F.concat(F.lit(" Actor "), "o_orderstatus", F.lit(" ")))
    raw = t.orders.join(lists, "o_orderkey").select(_s("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("created"), adversary.alias("adversary"), F.array(F.concat(F.lit("M"), "o_orderpriority")).alias("malware_families"), "indicators")
    return feeds.pulses(t.spark, _json(t, raw)).select("pulse", "kind", "indicator_type", "value", F.unix_timestamp("seen").alias("seen"), "source")


@query("S2_cve_feed", """SELECT 'CVE-2024-' || p_partkey::VARCHAR AS value, CASE WHEN p_size <= 40 THEN p_size / 4.0e0 END AS score, CASE p_partkey % 3 WHEN 2 THEN 'UNKNOWN' ELSE 'HIGH' END AS severity, CASE p_partkey % 3 WHEN 0 THEN 'NETWORK' WHEN 1 THEN 'LOCAL' ELSE 'UNKNOWN' END AS attack_vector,
  CASE p_size % 3 WHEN 0 THEN 'CWE-0|CWE-1' WHEN 1 THEN 'CWE-1' ELSE 'CWE-1|CWE-2' END AS cwes, least(10, p_size) AS constraints, 'cpe:2.3:a:' || p_brand || ':x:1 ' || p_brand || ' x' AS product FROM part""")
def cve_feed(t):
    c = F.col
    k, score = c("p_partkey") % 3, c("p_size") / F.lit(4.0)
    pick = lambda n, severity, vector: F.when(k == n, F.struct(score.alias("baseScore"), F.lit(severity).alias("baseSeverity"), F.lit(vector).alias("vectorString")))
    weak = F.array(F.array(F.concat(F.lit("CWE-"), (c("p_size") % 3).cast("string")), F.lit("CWE-1")), F.array(F.lit("CWE-1")))
    raw = t.part.select(F.concat(F.lit("cve-2024-"), _s("p_partkey")).alias("id"), pick(0, "high", "CVSS:3.1/AV:N/AC:L").alias("v31"), pick(1, "High", "CVSS:3.0/AV:L/AC:L").alias("v30"), pick(2, None, "AC:L").alias("v2"), weak.alias("weaknesses"), F.array_repeat(F.concat(F.lit("cpe:2.3:a:"), "p_brand", F.lit(":x:1")), c("p_size")).alias("cpes"))
    out = feeds.cve_feed(t.spark, _json(t, raw))
    return out.select("value", "score", "severity", "attack_vector", F.array_join("cwes", "|").alias("cwes"), F.size("version_constraints").alias("constraints"), F.get("products", F.lit(0)).alias("product"))


@query("S3_windows", """SELECT n_nationkey, w AS "window", greatest(s, DATE '2024-01-01' - (w * 120 + 119)::INTEGER)::VARCHAR AS lo, (DATE '2024-01-01' - (w * 120)::INTEGER)::VARCHAR AS hi FROM (SELECT n_nationkey, s, unnest(range(0, (DATE '2024-01-01' - s) // 120 + 1))::INTEGER AS w FROM
  (SELECT n_nationkey, DATE '2022-05-01' + (n_nationkey * 30)::INTEGER AS s FROM nation) x WHERE s <= DATE '2024-01-01') y""")
def windows(t):
    day = lambda s: F.lit(s).cast("date")
    rows = t.nation.select("n_nationkey", F.date_add(day("2022-05-01"), F.col("n_nationkey") * 30).alias("start"), day("2024-01-01").alias("end"))
    return feeds.windows_table(rows, "start", "end").select("n_nationkey", "window", _s("lo").alias("lo"), _s("hi").alias("hi"))


@query("S5_attack_relations", """SELECT 'uses' AS type, 'malware' AS source_type, m.name AS source_name, t.mitre_id AS target FROM malware m JOIN technique t ON t.mitre_id = 'T' || (1000 + m.malware_id % 20)::VARCHAR
  UNION ALL SELECT 'attributed_to', 'malware', m.name, a.name FROM malware m JOIN actor a ON a.actor_id = m.nationkey UNION ALL SELECT 'subtechnique_of', 'technique', mitre_id, 'T1000' FROM technique WHERE 'T1000' IN (SELECT mitre_id FROM technique)
  UNION ALL SELECT 'uses', 'tool', name, 'T1001' FROM tool WHERE 'T1001' IN (SELECT mitre_id FROM technique)""")
def attack_relations(t):
    c = F.col
    null = F.lit(None).cast("string")

    def thing(df, kind, key, name, mitre=null):
        return df.select(key.alias("id"), F.lit(kind).alias("type"), name.alias("name"), mitre.alias("mitre_id"), null.alias("relationship_type"), null.alias("source_ref"), null.alias("target_ref"))

    def relation(df, kind, src, trg):
        return df.select(null.alias("id"), F.lit("relationship").alias("type"), null.alias("name"), null.alias("mitre_id"), F.lit(kind).alias("relationship_type"), src.alias("source_ref"), trg.alias("target_ref"))

    key = lambda p, x: F.concat(F.lit(p + "--"), c(x).cast("string"))
    techniques = t.technique.select("mitre_id").distinct()
    mal, act, tool, tech = key("malware", "malware_id"), key("intrusion-set", "actor_id"), key("tool", "tool_id"), key("attack-pattern", "mitre_id")
    parts = [
        thing(t.malware, "malware", mal, c("name")), thing(t.actor, "intrusion-set", act, c("name")), thing(t.tool, "tool", tool, c("name")), thing(techniques, "attack-pattern", tech, c("mitre_id"), c("mitre_id")),
        relation(t.malware, "uses", mal, F.concat(F.lit("attack-pattern--T"), (c("malware_id") % 20 + 1000).cast("string"))), relation(t.malware, "attributed-to", mal, key("intrusion-set", "nationkey")),
        relation(t.tool, "uses", tool, F.lit("attack-pattern--T1001")), relation(techniques, "subtechnique-of", tech, F.lit("attack-pattern--T1000")), relation(t.actor, "attributed-to", act, act),
    ]
    return feeds.attack_relations(t.spark, _json(t, *parts)).select("type", "source_type", "source_name", F.coalesce("target_id", "target_name").alias("target"))


@query("S6_iocs", """SELECT CASE p_size % 3 WHEN 0 THEN 'ipv4' WHEN 1 THEN 'md5' ELSE 'unknown' END AS indicator_type, CASE p_size % 3 WHEN 0 THEN '10.0.0.' ELSE 'v' END || p_partkey::VARCHAR AS value, lower(p_brand) AS malware, (p_size * 2) / 100.0e0 AS confidence, greatest(1, least(7, p_size - 5)) AS days FROM part""")
def iocs(t):
    k = F.col("p_size") % 3
    raw = t.part.select(F.when(k == 0, F.concat(F.lit("10.0.0."), _s("p_partkey"), F.lit(":443"))).otherwise(F.concat(F.lit("v"), _s("p_partkey"))).alias("ioc"), F.when(k == 0, "ip:port").when(k == 1, "md5_hash").otherwise("odd").alias("ioc_type"), F.col("p_brand").alias("malware"), (F.col("p_size") * 2).alias("confidence_level"))
    return feeds.ioc_feed(t.spark, _json(t, raw)).select("indicator_type", "value", "malware", "confidence", S.request_days((F.col("confidence") * 50).cast("int") - 5).alias("days"))


_SICK, _GRID = Z.KEYWORDS["healthcare"][0], Z.KEYWORDS["energy"][0]


@query("S7_urls", f"""SELECT min(p_partkey) AS id, 'http://h/' || (p_partkey // 2)::VARCHAR AS value, min_by(CASE WHEN p_size % 3 = 0 THEN 'healthcare' WHEN p_size % 2 = 0 THEN 'energy' ELSE 'global' END, p_partkey) AS zones, epoch(TIMESTAMP '2024-01-01 10:00:00')::BIGINT AS seen FROM part WHERE p_size < 50 GROUP BY p_partkey // 2""")
def urls(t):
    n = F.col("p_size")
    url = F.concat(F.when(n < 50, "http://h/").otherwise("ftp://h/"), F.floor(F.col("p_partkey") / 2).cast("string"))
    threat, tags = F.when(n % 3 == 0, f"drop, {_SICK}").otherwise("drop"), F.when(n % 2 == 0, f"a {_GRID},b").otherwise("exe")
    path = _csv(t, t.part, F.col("p_partkey"), F.lit("2024-01-01 10:00:00"), url, F.lit("online"), F.lit(None), threat, tags, F.lit("link"), F.lit("me"))
    return feeds.url_feed(t.spark, path).select("id", "value", F.array_join("zones", "|").alias("zones"), F.unix_timestamp("seen").alias("seen"))


@query("S8_hashes", "SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN md5(p_brand) WHEN 1 THEN sha1(p_brand) ELSE sha256(p_brand) END AS value, CASE p_partkey % 3 WHEN 0 THEN 'md5' WHEN 1 THEN 'sha1' ELSE 'sha256' END AS indicator_type FROM part")
def hashes(t):
    k, v = F.col("p_partkey") % 3, F.col("p_brand")
    line = F.when(k == 0, F.upper(F.md5(v))).when(k == 1, F.sha1(v)).otherwise(F.sha2(v, 256))
    path = _text(t, t.part.select(line.alias("value")).unionByName(t.part.select(F.concat(F.lit("# "), v).alias("value"))))
    return feeds.hash_lines(t.spark, path).select("value", "indicator_type")


@query("S9_blocklist", "SELECT 'ipv4' AS indicator_type, '10.1.' || (p_partkey // 250)::VARCHAR || '.' || (p_partkey % 250)::VARCHAR AS value, lower(p_brand) AS malware, epoch(TIMESTAMP '2024-01-02 03:04:05')::BIGINT AS seen FROM part")
def blocklist(t):
    ip = F.concat(F.lit("10.1."), F.floor(F.col("p_partkey") / 250).cast("string"), F.lit("."), (F.col("p_partkey") % 250).cast("string"))
    path = _csv(t, t.part, F.lit("2024-01-02 03:04:05"), ip, F.lit(443), F.lit("online"), F.lit("2024-01-03"), F.col("p_brand"))
    return feeds.blocklist(t.spark, path).select("indicator_type", "value", "malware", F.unix_timestamp("seen").alias("seen"))


@query("S10_certificates", "SELECT 'sha1' AS indicator_type, sha1(p_partkey::VARCHAR) AS value, p_brand AS reason FROM part")
def certificates(t):
    path = _csv(t, t.part, F.lit("2024-01-02"), F.upper(F.sha1(_s("p_partkey"))), F.col("p_brand"))
    return feeds.certificates(t.spark, path).select("indicator_type", "value", "reason")


@query("S11_ip_reputation", """WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey % 20 AS a, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey % 20) AS k FROM lineitem)
  SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'ipv4' ELSE 'ipv6' END AS indicator_type, CASE WHEN l_orderkey % 2 = 0 THEN '10.' ELSE '::' END || l_orderkey::VARCHAR AS value, (l_orderkey % 101) / 100.0e0 AS confidence, array_to_string(list_sort(list_distinct(flatten([list(a), [7]]))), '|') AS categories FROM r WHERE k <= 5 GROUP BY l_orderkey""")
def ip_reputation(t):
    k = F.col("l_orderkey")
    one = F.struct("l_linenumber", F.array((F.col("l_partkey") % 20).cast("int"), F.lit(7)).alias("categories"))
    rows = t.lineitem.groupBy(k).agg(F.array_sort(F.collect_list(one)).alias("r"))
    raw = rows.select(F.concat(F.when(k % 2 == 0, "10.").otherwise("::"), k.cast("string")).alias("ipAddress"), (k % 101).alias("abuseConfidenceScore"), F.transform("r", lambda x: F.struct(x["categories"].alias("categories"))).alias("reports"))
    return feeds.ip_reputation(t.spark, _json(t, raw)).select("indicator_type", "value", "confidence", F.array_join("abuse_categories", "|").alias("categories"))


@query("S12_S13_look_up", """WITH r AS (SELECT 'v' || (p_partkey // 2)::VARCHAR AS value, p_partkey % 4 AS m, CASE WHEN p_size % 2 = 0 THEN 0.5e0 + 0.45e0 * (p_partkey % 4) / 16 ELSE 0.5e0 + 0.45e0 * (p_partkey % 4) / 8 END AS c FROM part WHERE p_partkey % 6 > 0)
  SELECT s_suppkey, round(max(c), 2) AS confidence, max(m) AS malicious FROM supplier LEFT JOIN r ON r.value = 'v' || s_suppkey::VARCHAR GROUP BY s_suppkey""")
def look_up(t):
    bad = (F.col("p_partkey") % 4).cast("int")
    stats = F.struct(bad.alias("malicious"), F.lit(0).alias("suspicious"), (F.when(F.col("p_size") % 2 == 0, 16).otherwise(8) - bad).alias("harmless"))
    raw = t.part.where("p_partkey % 6 > 0").select(F.concat(F.lit("v"), F.floor(F.col("p_partkey") / 2).cast("string")).alias("value"), F.lit("MD5").alias("kind"), stats.alias("stats"))
    asked = t.supplier.select("s_suppkey", F.lit("md5").alias("indicator_type"), F.concat(F.lit("v"), _s("s_suppkey")).alias("value"))
    return feeds.look_up(asked, feeds.verdicts(t.spark, _json(t, raw))).select("s_suppkey", "confidence", "malicious")


@query("S14_galaxy", "SELECT event_id, idx, CASE idx % 3 WHEN 0 THEN 'T' || (1000 + indicator_id % 90)::VARCHAR || '=Access Token' WHEN 1 THEN 'T1059.001=Shell T1059.001 use' ELSE '' END AS techniques, CASE WHEN idx % 2 = 0 THEN 'CVE-2024-' || (10000 + indicator_id)::VARCHAR END AS cve_id FROM attribute")
def galaxy(t):
    k = F.col("idx") % 3
    tag = F.when(k == 0, F.concat(F.lit('misp-galaxy:mitre-attack-pattern="Access Token - T'), (F.col("indicator_id") % 90 + 1000).cast("string"), F.lit('"'))).when(k == 1, 'x:pattern="Shell T1059.001 use"').otherwise("tlp:white")
    value = F.concat(F.when(F.col("idx") % 2 == 0, "see cve-2024-").otherwise("cve-24-"), (F.col("indicator_id") + 10000).cast("string"), F.lit(" now"))
    out = feeds.galaxy_items(t.attribute.select("event_id", "idx", value.alias("value"), F.array(F.lit("tlp:red"), tag).alias("tags")))
    return out.select("event_id", "idx", F.array_join(F.transform("techniques", lambda x: F.concat_ws("=", x["id"], x["name"])), "|").alias("techniques"), "cve_id")


@query("S16_event_index", "SELECT o_orderkey FROM orders WHERE o_orderkey % 3 < 2 AND CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate >= TIMESTAMP '1999-01-01 12:00:00' WHEN o_orderkey % 5 > 0 THEN o_orderdate::DATE >= DATE '1998-12-31' ELSE TRUE END")
def event_index(t):
    k = F.col("o_orderkey")
    index = t.orders.select("o_orderkey", F.when(k % 3 < 2, "KG-nvd-2024").otherwise("Other-KG-").alias("info"), F.when(k % 2 == 0, F.col("o_orderdate")).alias("ts"), F.when(k % 5 > 0, F.to_date("o_orderdate")).alias("date"))
    return P.keep_events(index, "KG-", F.lit("1999-01-01 12:00:00").cast("timestamp")).select("o_orderkey")


@query("S17_P10_parse", """WITH a AS (SELECT event_id, idx, CASE idx % 7 WHEN 0 THEN 'vulnerability' WHEN 3 THEN 'actor' WHEN 4 THEN 'malware' WHEN 5 THEN 'technique' ELSE 'indicator' END AS kind,
    CASE idx % 7 WHEN 0 THEN 'cve:CVE-2024-' || (indicator_id % 3)::VARCHAR WHEN 1 THEN 'ipv4:10.0.0.' || (indicator_id % 50)::VARCHAR WHEN 2 THEN 'domain:h' || (indicator_id % 50)::VARCHAR WHEN 3 THEN 'actor:Bear ' || malware_id::VARCHAR WHEN 4 THEN 'malware:Worm ' || malware_id::VARCHAR ELSE 'technique:T' || (1000 + indicator_id % 40)::VARCHAR END AS key,
    CASE source_name WHEN 'AlienVault-OTX' THEN 'alienvault_otx' WHEN 'NVD' THEN 'nvd' WHEN 'CISA-KEV' THEN 'cisa_kev' WHEN 'URLhaus' THEN 'urlhaus' ELSE 'misp' END AS source, CASE WHEN zone IN ('energy', 'finance', 'healthcare') THEN zone ELSE 'energy' END AS zones,
    CASE WHEN idx % 7 = 0 THEN 7.5e0 END AS score, CASE WHEN idx % 7 = 3 THEN 'T1|T2' ELSE '' END AS uses, CASE WHEN idx % 7 = 5 THEN 'impact' ELSE '' END AS phases FROM attribute WHERE idx % 7 < 6)
  SELECT event_id, key, min(kind) AS kind, min_by(source, idx) AS source, min_by(zones, idx) AS zones, min(score) AS score, min(uses) AS uses, min(phases) AS phases FROM a GROUP BY event_id, key""")
def parsed(t):
    """Staging events as nested JSON through the reader, the exploder, the parser and the dedup inside an event. An event's rows are gathered as they
    are, and become texts in their list."""

    def attribute(row):
        k, ind, mal = row["idx"] % 7, (lambda n: (row["indicator_id"] % n).cast("string")), row["malware_id"].cast("string")
        pick = lambda *xs: reduce(lambda a, x: a.when(k == x[0], x[1]), xs[1:], F.when(k == xs[0][0], xs[0][1]))
        kind = pick((0, "vulnerability"), (1, "ip-dst"), (2, "hostname"), (3, "threat-actor"), (4, "malware-type"), (5, "text"), (6, "url"))
        value = pick((0, F.concat(F.lit(" cve-2024-"), ind(3))), (1, F.concat(F.lit("10.0.0."), ind(50))), (2, F.concat(F.lit("h"), ind(50), F.lit(" "))), (3, F.concat(F.lit("Bear "), mal)), (4, F.concat(F.lit("Worm "), mal)), (5, F.concat(F.lit("T"), (row["indicator_id"] % 40 + 1000).cast("string"))), (6, F.lit("  ")))
        comment = pick((0, F.lit('NVD_META:{"cvss_v31_data": {"base_score": 7.5}}')), (3, F.lit('MITRE_USES_TECHNIQUES:{"t": ["T1", "T2"]}\nmore')), (5, F.lit('MITRE_TACTIC_PHASES:["impact"]')), (4, F.lit("MITRE_USES_TECHNIQUES:{broken")))
        name = lambda c: F.struct(c.alias("name"))
        return F.struct(row["idx"].alias("idx"), kind.alias("type"), value.alias("value"), comment.alias("comment"), F.array(name(F.concat(F.lit("source:"), row["source_name"])), name(F.concat(F.lit("zone:"), row["zone"]))).alias("tags"))

    rows = F.array_sort(F.collect_list(F.struct("idx", "indicator_id", "malware_id", "source_name", "zone")))
    events = t.attribute.groupBy("event_id").agg(rows.alias("rows")).select(_s("event_id").alias("id"), F.transform("rows", attribute).alias("attributes"), F.array(F.struct(F.lit("sector: Energy").alias("name"))).alias("tags"))
    attrs = P.explode_events(feeds.staging_events(t.spark, _json(t, events)))
    # The dedup takes whole rows, so it is given the columns that are asked for.
    items = P.dedup_items(P.parse_attributes(attrs).select("event_id", "idx", "key", "kind", "source", "zones", "score", "uses_techniques", "tactic_phases"))
    return items.select(F.col("event_id").cast("long").alias("event_id"), "key", "kind", "source", F.array_join("zones", "|").alias("zones"), "score", F.array_join("uses_techniques", "|").alias("uses"), F.array_join("tactic_phases", "|").alias("phases"))


@query("P9_meta", """SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'T' || p_size::VARCHAR || '|T2' WHEN 1 THEN 'T3' ELSE '' END AS uses, CASE WHEN p_size % 6 = 2 THEN 'impact' ELSE '' END AS phases, CASE p_size % 6 WHEN 3 THEN 'otx' WHEN 5 THEN 'tf' END AS feed FROM part""")
def meta(t):
    k = F.col("p_size") % 6
    comment = F.when(k == 0, F.concat(F.lit('MITRE_USES_TECHNIQUES:{"t": ["T'), _s("p_size"), F.lit('", "T2"]}\nA text [1]'))).when(k == 1, ' MITRE_USES_TECHNIQUES: ["T3"]').when(k == 2, 'MITRE_TACTIC_PHASES:{"p": ["impact"]}')
    comment = comment.when(k == 3, 'OTX_META:{"name": "otx"}').when(k == 4, 'TF_META:{"name": "tf"').otherwise('TF_META:{"name": "tf"}')
    c = F.col("comment")
    feed = F.get_json_object(F.coalesce(G.meta_json(c, "OTX_META:"), G.meta_json(c, "TF_META:")), "$.name")
    rows = t.part.select("p_partkey", comment.alias("comment"))
    return rows.select("p_partkey", F.array_join(G.meta_list(c, "MITRE_USES_TECHNIQUES:", "t"), "|").alias("uses"), F.array_join(G.meta_list(c, "MITRE_TACTIC_PHASES:", "p"), "|").alias("phases"), feed.alias("feed"))


@query("P11_P14_cve_ids", """SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'CVE-1' WHEN 1 THEN 'CVE-' || p_partkey::VARCHAR END AS cve_id, p_size % 4 < 3 AS accepted FROM part""")
def cve_ids(t):
    k = F.col("p_size") % 4
    own = F.when(k == 0, " cve-1 ").when(k == 1, " ")
    value = F.when(k == 3, F.repeat(F.lit("é"), F.lit(2049))).otherwise(F.concat(F.lit("cve-"), _s("p_partkey")))
    kind = F.when(k < 2, "vulnerability").otherwise("indicator")
    return t.part.select("p_partkey", S.cve_of(own, kind, value).alias("cve_id"), S.accepted_value(value).alias("accepted"))


@query("P21_aliases", "SELECT malware_id, least(50, 1 + malware_id % 60) AS n, left(name || repeat('x', 300), 200) AS first FROM malware")
def aliases(t):
    long = F.concat(F.col("name"), F.repeat(F.lit("x"), F.lit(300)))
    names = F.concat(F.array(F.lit("unknown"), F.lit(" "), F.lit(None).cast("string"), long), F.transform(F.sequence(F.lit(1), F.col("malware_id") % 60 + 1), lambda x: F.concat(F.lit("a"), x.cast("string"))))
    kept = S.aliases_clean(F.slice(names, 1, F.size(names) - 1), is_placeholder)
    return t.malware.select("malware_id", F.size(kept).alias("n"), F.get(kept, F.lit(0)).alias("first"))


@query("P26_F23_sizes", "SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN s_suppkey WHEN 1 THEN 7 ELSE 0 END AS size, (DATE '2024-01-15' - floor((s_suppkey % 25) * 30.437e0)::INTEGER)::VARCHAR AS cutoff FROM supplier")
def sizes(t):
    k = F.col("s_suppkey")
    size = S.event_size(F.when(k % 3 == 0, k.cast("string")).otherwise("many"), F.when(k % 3 == 1, "7"))
    return t.supplier.select("s_suppkey", size.alias("size"), S.month_cutoff(F.lit("2024-01-15").cast("date"), k % 25).cast("string").alias("cutoff"))


@query("S19_R3_load_bundle", """SELECT 'malware' AS a, name AS b, 0.7e0 AS confidence FROM malware UNION ALL SELECT 'intrusion-set', name, 0.7e0 FROM actor UNION ALL SELECT DISTINCT 'attack-pattern', mitre_id, 0.8e0 FROM technique UNION ALL SELECT DISTINCT 'x-mitre-tactic', shortname, 1.0e0 FROM tactic
  UNION ALL SELECT 'indicator', value, 0.7e0 FROM indicator UNION ALL SELECT 'indicates ' || i.value, m.name, NULL FROM indicates x JOIN indicator i ON i.indicator_id = x.indicator_id JOIN malware m ON m.malware_id = x.malware_id""")
def load_bundle(t):
    c = F.col
    key = lambda p, x: F.concat(F.lit(p + "--"), c(x).cast("string"))
    null = F.lit(None).cast("string")

    def obj(df, kind, ident, name=null, pattern=null, rel=null, src=null, trg=null):
        return df.select(F.to_json(F.struct(F.lit(kind).alias("type"), ident.alias("id"), name.alias("name"), pattern.alias("pattern"), rel.alias("relationship_type"), src.alias("source_ref"), trg.alias("target_ref"))).alias("object"))

    parts = [
        obj(t.malware, "malware", key("malware", "malware_id"), c("name")), obj(t.actor, "intrusion-set", key("intrusion-set", "actor_id"), c("name")),
        obj(t.technique, "attack-pattern", key("attack-pattern", "mitre_id"), c("mitre_id")), obj(t.tactic, "x-mitre-tactic", key("x-mitre-tactic", "mitre_id"), c("shortname")),
        obj(t.indicator, "indicator", key("indicator", "indicator_id"), null, S.stix_pattern(F.lit("domain"), c("value"))),
        obj(t.indicates, "relationship", key("relationship", "indicator_id"), null, null, F.lit("indicates"), key("indicator", "indicator_id"), key("malware", "malware_id")),
        obj(t.actor, "relationship", key("relationship", "actor_id"), null, null, F.lit("uses"), key("intrusion-set", "actor_id"), F.lit("tool--none")),
    ]
    # The objects are written once: nodes and both ends of relations read them from there.
    path = _text(t, reduce(DataFrame.unionByName, parts))
    nodes, relations = stix.load_bundle(t.spark.read.text(path).withColumnRenamed("value", "object"))
    edges = relations.select(F.concat_ws(" ", "type", "s_name").alias("a"), c("t_name").alias("b"), F.lit(None).cast("double").alias("confidence"))
    return nodes.select(c("type").alias("a"), c("name").alias("b"), "confidence").unionByName(edges)


_ASKED = {
    "Show high severity CVEs": ("label IN ('Vulnerability', 'CVE') AND (severity IN ('HIGH', 'CRITICAL') OR score >= 7)", None),
    "medium vulnerability list": ("label IN ('Vulnerability', 'CVE') AND severity = 'MEDIUM'", None),
    "threats of APT groups": ("label = 'ThreatActor'", "finance"),
    "IP addresses": ("label = 'Indicator' AND type = 'ipv4'", None),
    "malicious things": ("label = 'Indicator'", None),
    "low cvss": ("label IN ('Vulnerability', 'CVE') AND severity = 'LOW'", None),
    "captured domain names": ("label = 'ThreatActor'", None),
    "domains of botnets": ("label = 'Indicator' AND type = 'domain'", None),
    "everything": ("TRUE", "energy"),
}
_NODES = """n AS (SELECT 'Vulnerability' AS label, cve_id AS key, NULL AS type, severity, score, zones, TRUE AS managed FROM vulnerability UNION ALL SELECT 'CVE', cve_id, NULL, severity, score, zones, TRUE FROM cve
  UNION ALL SELECT 'ThreatActor', name, NULL, NULL, NULL, zone, TRUE FROM actor UNION ALL SELECT 'Indicator', value, indicator_type, NULL, NULL, 'global', size % 2 = 0 FROM indicator
  UNION ALL SELECT 'Malware', name, NULL, NULL, NULL, 'finance', TRUE FROM malware UNION ALL SELECT DISTINCT 'Technique', mitre_id, NULL, NULL, NULL, 'global', TRUE FROM technique UNION ALL SELECT 'Campaign', name || ' Campaign', NULL, NULL, NULL, zone || ';energy', TRUE FROM actor)"""


@query("Q1_router", f"WITH {_NODES} " + " UNION ALL ".join(f"SELECT '{q}' AS question, label, key FROM n WHERE managed AND {rule}" + (f" AND list_contains(split(zones, ';'), '{zone}')" if zone else "") for q, (rule, zone) in _ASKED.items()))
def router(t):
    c, null = F.col, F.lit(None)
    node = lambda df, label, key, kind=null, severity=null, score=null, zones=F.lit("global"), managed=F.lit(True): df.select(F.lit(label).alias("label"), key.alias("key"), kind.cast("string").alias("type"), severity.cast("string").alias("severity"), score.cast("double").alias("score"), F.split(zones, ";").alias("zones"), managed.alias("managed"))
    nodes = reduce(DataFrame.unionByName, [*[node(df, label, c("cve_id"), null, c("severity"), c("score"), c("zones")) for label, df in (("Vulnerability", t.vulnerability), ("CVE", t.cve))], node(t.actor, "ThreatActor", c("name"), zones=c("zone")), node(t.indicator, "Indicator", c("value"), c("indicator_type"), managed=c("size") % 2 == 0),
                                          node(t.malware, "Malware", c("name"), zones=F.lit("finance")), node(t.technique.select("mitre_id").distinct(), "Technique", c("mitre_id")), node(t.actor, "Campaign", F.concat("name", F.lit(" Campaign")), zones=F.concat("zone", F.lit(";energy")))])
    return reduce(DataFrame.unionByName, [V.answer(q, nodes, zone).select(F.lit(q).alias("question"), "label", "key") for q, (_, zone) in _ASKED.items()])


_LISTS = {"Malware": ("malware", "name"), "Tool": ("tool", "name"), "Technique": ("technique", "mitre_id"), "Tactic": ("tactic", "shortname"), "Campaign": ("nation", "n_name")}


@query("Q15_Q16_all_lists", " UNION ALL ".join(f"SELECT * FROM (SELECT '{label}' AS label, {c} AS name FROM {table} WHERE contains(lower({c}), '0') OR contains(lower({c}), 'a') ORDER BY {c} LIMIT 100) x" for label, (table, c) in _LISTS.items()))
def all_lists(t):
    has = lambda c: F.contains(F.lower(c), F.lit("0")) | F.contains(F.lower(c), F.lit("a"))
    return reduce(DataFrame.unionByName, [getattr(t, table).where(has(c)).select(F.lit(label).alias("label"), F.col(c).alias("name")).orderBy("name").limit(100) for label, (table, c) in _LISTS.items()])


@query("M5_M7_single", """SELECT 'Source' AS label, source_name AS key, max_by(zone, seq) AS last, NULL AS listed, max(confidence) AS confidence FROM attribute GROUP BY source_name
  UNION ALL SELECT 'Malware', m.name, max_by(a.zone, a.seq), string_agg(DISTINCT a.source_name, '|' ORDER BY a.source_name), max(a.confidence) FROM attribute a JOIN malware m ON m.malware_id = a.malware_id GROUP BY m.name
  UNION ALL SELECT 'Technique', i.attack_id, max_by(a.zone, a.seq), string_agg(DISTINCT a.source_name, '|' ORDER BY a.source_name), max(a.confidence) FROM attribute a JOIN indicator i ON i.indicator_id = a.indicator_id GROUP BY i.attack_id""")
def single(t):
    """Upserts of the labels that have one key column; a source keeps only what was written last."""
    a = t.attribute.withColumn("listed", F.array("source_name"))
    sources = M.merge_nodes(a, ["source_name"], "seq", last=["zone"], highest=["confidence"]).withColumn("listed", F.lit(None).cast("array<string>"))
    mal = M.merge_nodes(a.join(t.malware.select("malware_id", "name"), "malware_id"), ["name"], "seq", last=["zone"], highest=["confidence"], sets=["listed"])
    tech = M.merge_nodes(a.join(t.indicator.select("indicator_id", "attack_id"), "indicator_id"), ["attack_id"], "seq", last=["zone"], highest=["confidence"], sets=["listed"])
    one = lambda df, label, key: df.select(F.lit(label).alias("label"), F.col(key).alias("key"), F.col("zone").alias("last"), F.array_join("listed", "|").alias("listed"), "confidence")
    return one(sources, "Source", "source_name").unionByName(one(mal, "Malware", "name")).unionByName(one(tech, "Technique", "attack_id"))
