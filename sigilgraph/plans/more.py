"""Further queries: audits, views, alternative merges and links."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import enrich as E
from ..operators import link as L
from ..operators import merge as M
from ..operators import serve as V
from ..operators import topology as TP
from .catalog import query


@query("J14_chain", "SELECT a.name AS actor, count(DISTINCT m.malware_id) AS malware, count(DISTINCT l.indicator_id) AS live FROM actor a LEFT JOIN malware m ON m.nationkey = a.actor_id LEFT JOIN indicates i ON i.malware_id = m.malware_id LEFT JOIN live l ON l.indicator_id = i.indicator_id AND l.active GROUP BY a.name")
def chain(t):
    m = t.malware.select("malware_id", F.col("nationkey").alias("actor_id"))
    live = t.indicates.join(t.live.where("active").select("indicator_id"), "indicator_id", "left_semi").join(m, "malware_id").groupBy("actor_id").agg(F.countDistinct("indicator_id").alias("live"))
    mal = m.groupBy("actor_id").agg(F.count("*").alias("malware"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return t.actor.select("actor_id", F.col("name").alias("actor")).join(mal, "actor_id", "left").join(live, "actor_id", "left").select("actor", zero("malware"), zero("live"))


@query("J15_per_source_times", "SELECT indicator_id, epoch(min(f))::BIGINT AS first, epoch(max(l))::BIGINT AS last, count(*) AS sources FROM (SELECT indicator_id, source_name, min(seen) AS f, max(seen) AS l FROM attribute GROUP BY indicator_id, source_name) x GROUP BY indicator_id")
def per_source(t):
    claims = t.attribute.select("indicator_id", "source_name", F.col("seen").alias("f"), F.col("seen").alias("l"), F.col("zone").alias("raw"), "seq")
    edges = M.merge_provenance(claims, ["indicator_id"], "source_name", "f", "l", "raw", "seq")
    return edges.groupBy("indicator_id").agg(F.unix_timestamp(F.min("f")).alias("first"), F.unix_timestamp(F.max("l")).alias("last"), F.count("*").alias("sources"))


@query("J17_by_name_or_alias", "SELECT DISTINCT lower(x.k) AS k, a.actor_id FROM (SELECT n_name AS k FROM nation UNION ALL SELECT 'ALIAS-' || n_name FROM nation UNION ALL SELECT 'unknown') x JOIN (SELECT actor_id, lower(name) AS k FROM actor UNION ALL SELECT actor_id, lower(u) FROM (SELECT actor_id, unnest(split(aliases, ';')) AS u FROM actor) y) a ON lower(x.k) = a.k WHERE a.k <> 'unknown'")
def by_name_or_alias(t):
    asked = t.nation.select(F.col("n_name").alias("k")).unionByName(t.nation.select(F.concat(F.lit("ALIAS-"), "n_name").alias("k"))).unionByName(t.spark.createDataFrame([("unknown",)], "k string"))
    key = L.names_of(F.col("k"))
    return L.or_join(asked, t.actor, [(key, L.names_of(F.col("name"))), (key, L.names_of(F.split("aliases", ";"), lists=True))], [F.lower("k").alias("k"), F.col("actor_id")])


@query("J18_by_value", "SELECT i.indicator_id, count(*) AS n FROM indicator i JOIN (SELECT 'val-' || l_partkey::VARCHAR AS v FROM lineitem) x ON lower(i.value) = x.v GROUP BY i.indicator_id")
def by_value(t):
    asked = t.lineitem.select(F.concat(F.lit("val-"), F.col("l_partkey").cast("string")).alias("v"))
    return t.indicator.select("indicator_id", F.lower("value").alias("v")).join(asked, "v").groupBy("indicator_id").agg(F.count("*").alias("n"))


@query("J21_alert_context", "SELECT e.event_id, c.c_name AS customer, s.s_name AS supplier FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id LEFT JOIN supplier s ON s.s_suppkey = e.user_id")
def alert_context(t):
    out = t.events.join(t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("customer")), "user_id", "left")
    return out.join(t.supplier.select(F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("supplier")), "user_id", "left").select("event_id", "customer", "supplier")


@query("J26_delta", "SELECT coalesce(a.cve_id, b.cve_id) AS cve_id, CASE WHEN a.cve_id IS NULL THEN 'only there' WHEN b.cve_id IS NULL THEN 'only here' WHEN a.score IS DISTINCT FROM b.score THEN 'changed' ELSE 'same' END AS state FROM vulnerability a FULL JOIN cve b ON a.cve_id = b.cve_id")
def delta(t):
    a, b = t.vulnerability.select("cve_id", "score", F.lit(1).alias("x")), t.cve.select("cve_id", F.col("score").alias("other"), F.lit(1).alias("y"))
    state = F.when(F.col("x").isNull(), "only there").when(F.col("y").isNull(), "only here").when(~F.col("score").eqNullSafe(F.col("other")), "changed").otherwise("same")
    return a.join(b, "cve_id", "full").select("cve_id", state.alias("state"))


@query("A12_extremes", "SELECT source_name AS source, epoch(min(seen))::BIGINT AS first, epoch(max(seen))::BIGINT AS last FROM attribute GROUP BY source_name")
def extremes(t):
    return t.attribute.groupBy(F.col("source_name").alias("source")).agg(F.unix_timestamp(F.min("seen")).alias("first"), F.unix_timestamp(F.max("seen")).alias("last"))


@query("M3_batch_refusals", "SELECT count(DISTINCT (k, l_orderkey, l_linenumber)) FILTER (k <> '') AS kept, count(*) AS claims FROM (SELECT CASE WHEN l_linenumber = 1 THEN '' ELSE l_partkey::VARCHAR END AS k, l_orderkey, l_linenumber FROM lineitem) x")
def refusals(t):
    key = F.when(F.col("l_linenumber") == 1, F.lit(" ")).otherwise(F.col("l_partkey").cast("string"))
    rows = t.lineitem.select(key.alias("k"), "l_orderkey", "l_linenumber", F.lit(1).alias("seq"))
    kept = M.merge_nodes(rows, ["k", "l_orderkey", "l_linenumber"], "seq").agg(F.count("*").alias("kept"))
    return kept.join(F.broadcast(rows.agg(F.count("*").alias("claims"))))


@query("M6_score_children", "SELECT cve_id, 'v31' AS version, score FROM vulnerability WHERE score IS NOT NULL UNION ALL SELECT cve_id, 'v2', score FROM cve WHERE score IS NOT NULL")
def children(t):
    rows = t.vulnerability.select("cve_id", F.lit("v31").alias("version"), "score").unionByName(t.cve.select("cve_id", F.lit("v2").alias("version"), "score")).withColumn("seq", F.lit(1))
    return M.merge_nodes(rows.dropna(subset=["score"]), ["cve_id", "version"], "seq", last=["score"])


@query("M10_alert_indicators", "SELECT 'ipv4' AS indicator_type, user_id::VARCHAR AS value, epoch_us(min(ts)) // 1000000 AS first, epoch_us(max(ts)) // 1000000 AS last, 0.8e0 AS confidence FROM events GROUP BY user_id")
def alert_indicators(t):
    kind = S.lookup({"ip": "ipv4", "file_hash": "hash"}, F.lit("ip"), "unknown")
    rows = t.events.select(kind.alias("indicator_type"), F.col("user_id").cast("string").alias("value"), F.col("ts").alias("first"), F.col("ts").alias("last"), F.lit(0.8).alias("confidence"), F.col("event_id").alias("seq"))
    out = M.merge_nodes(rows, ["indicator_type", "value"], "seq", highest=["confidence"], earliest=["first"], latest=["last"])
    return out.withColumns({"first": F.unix_timestamp("first"), "last": F.unix_timestamp("last")})


@query("M12_M13_source_links", "SELECT DISTINCT indicator_id AS src, source_name AS trg FROM attribute")
def source_links(t):
    sources = t.attribute.select("source_name").distinct()
    return L.link_exact(t.attribute, F.col("source_name"), "indicator_id", sources, F.col("source_name"), "source_name", "SOURCED_FROM", 1.0, "source").select("src", "trg")


@query("P20_wall_clock", "SELECT count(*) FILTER (abs((epoch_us(ts) // 1000000) - epoch(TIMESTAMP '2024-01-15 12:00:00')::BIGINT) <= 3600) AS near, count(*) AS n FROM events")
def wall_clock(t):
    return t.events.agg(F.count_if(S.is_wall_clock(F.col("ts"), F.lit("2024-01-15 12:00:00").cast("timestamp"), 3600)).alias("near"), F.count("*").alias("n"))


@query("P25_cpe", "SELECT p_partkey, 'cpe:2.3:a:' || p_brand || ':' || p_type || ':1 ' || p_brand || ' ' || p_type AS product FROM part")
def cpe(t):
    name = F.concat(F.lit("cpe:2.3:a:"), "p_brand", F.lit(":"), "p_type", F.lit(":1"))
    return t.part.select("p_partkey", S.cpe_text(name).alias("product"))


@query("Q5_Q13_vulnerabilities", "SELECT cve_id, score FROM (SELECT * FROM vulnerability UNION ALL SELECT * FROM cve) x WHERE score >= 2 ORDER BY score DESC NULLS FIRST, cve_id LIMIT 60")
def vulnerabilities(t):
    rows = t.vulnerability.select("cve_id", "score").unionByName(t.cve.select("cve_id", "score")).where("score >= 2")
    return V.page(rows, "score", "cve_id", 60)


@query("Q8_top_indicators", "SELECT indicator_id, confidence FROM live ORDER BY confidence DESC NULLS FIRST, indicator_id LIMIT 30")
def top_indicators(t):
    return V.page(t.live.select("indicator_id", "confidence"), "confidence", "indicator_id", 30)


@query("Q15_Q16_lists", "SELECT actor_id, name FROM actor WHERE zone = 'finance' AND contains(lower(name), 'a') ORDER BY name LIMIT 100")
def lists(t):
    return t.actor.where((F.col("zone") == "finance") & F.contains(F.lower("name"), F.lit("a"))).select("actor_id", "name").orderBy("name").limit(100)


@query("Q20_inactive", "SELECT indicator_id FROM live WHERE NOT active")
def inactive(t):
    return t.live.where(~F.coalesce("active", F.lit(True))).select("indicator_id")


@query("TOPOLOGY_all_edges", """SELECT DISTINCT 'SoftwareVersion' AS src_label, 'ON' AS type, 'Host' AS trg_label, l_partkey::VARCHAR AS src, l_suppkey::VARCHAR AS trg FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 40
  UNION SELECT 'Host', 'ON', 'SoftwareVersion', l_suppkey::VARCHAR, l_partkey::VARCHAR FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 40""")
def topology_edges(t):
    part, supp = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    one = lambda a, k, b, x, y: t.lineitem.select(F.lit(a).alias("src_label"), F.lit(k).alias("type"), F.lit(b).alias("trg_label"), x.alias("src"), y.alias("trg"))
    claims = one("SoftwareVersion", "ON", "Host", part, supp).unionByName(one("Host", "ON", "SoftwareVersion", supp, part)).unionByName(one("Host", "NEAR", "Host", supp, supp))
    nodes = t.part.where("p_size > 40").select(F.lit("SoftwareVersion").alias("label"), F.col("p_partkey").cast("string").alias("key")).unionByName(t.supplier.select(F.lit("Host").alias("label"), F.col("s_suppkey").cast("string").alias("key")))
    return TP.link_all(claims, nodes)


@query("TOPOLOGY_users", "SELECT c_name AS username, CASE WHEN c_nationkey % 2 = 0 THEN 'default' ELSE 'D' || c_nationkey::VARCHAR END AS domain, max(c_mktsegment) AS segment FROM customer GROUP BY 1, 2")
def users(t):
    domain = F.when(F.col("c_nationkey") % 2 == 0, F.lit(" ")).otherwise(F.concat(F.lit("D"), F.col("c_nationkey").cast("string")))
    return TP.merge_assets("User", t.customer.select(F.col("c_name").alias("username"), domain.alias("domain"), F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("seq")), "seq", ["segment"])


@query("STREAM_sessions", """WITH s AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOURS THEN 0 ELSE 1 END AS b FROM events), g AS (SELECT user_id, ts, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s)
  SELECT user_id, epoch_us(min(ts)) // 1000000 AS start, count(*) AS alerts FROM g GROUP BY user_id, k""")
def sessions(t):
    from ..streaming.alerts import sessions as run

    return run(t.events, "user_id", "6 hours").select("user_id", F.unix_timestamp("start").alias("start"), "alerts")


@query("A15_A16_A17_audits", """SELECT label, count(*) AS nodes, count(*) FILTER (id IS NULL) AS without_id, count(*) FILTER (NOT coalesce(managed, FALSE)) AS unmanaged, count(*) FILTER (events = 0) AS without_events FROM (
  SELECT 'Indicator' AS label, CASE WHEN i.indicator_id % 5 > 0 THEN i.value END AS id, CASE i.indicator_id % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS managed, coalesce(e.n, 0) AS events FROM indicator i LEFT JOIN (SELECT indicator_id, count(*) AS n FROM attribute WHERE idx > 6 GROUP BY indicator_id) e ON e.indicator_id = i.indicator_id
  UNION ALL SELECT 'Malware', m.name, TRUE, coalesce(e.n, 0) FROM malware m LEFT JOIN (SELECT malware_id, count(*) AS n FROM attribute WHERE idx > 6 GROUP BY malware_id) e ON e.malware_id = m.malware_id) x GROUP BY label""")
def audits(t):
    late = t.attribute.where("idx > 6")
    i = t.indicator.join(late.groupBy("indicator_id").agg(F.count("*").alias("n")), "indicator_id", "left").select(F.lit("Indicator").alias("label"), F.when(F.col("indicator_id") % 5 > 0, F.col("value")).alias("id"), F.when(F.col("indicator_id") % 3 == 0, True).when(F.col("indicator_id") % 3 == 1, False).alias("managed"), F.coalesce("n", F.lit(0)).alias("events"))
    m = t.malware.join(late.groupBy("malware_id").agg(F.count("*").alias("n")), "malware_id", "left").select(F.lit("Malware").alias("label"), F.col("name").alias("id"), F.lit(True).alias("managed"), F.coalesce("n", F.lit(0)).alias("events"))
    return V.audit(i.unionByName(m), "label", "id", "managed", "events")


@query("U3_U4_unions", "SELECT indicator_id, string_agg(zone, '|' ORDER BY f) AS zones, string_agg(source_name, '|' ORDER BY f) FILTER (k = 1) AS sources FROM (SELECT indicator_id, zone, NULL AS source_name, min(seq) AS f, 0 AS k FROM attribute GROUP BY indicator_id, zone UNION ALL SELECT indicator_id, NULL, source_name, min(seq), 1 FROM attribute GROUP BY indicator_id, source_name) x GROUP BY indicator_id")
def unions(t):
    rows = t.attribute.select("indicator_id", "seq", F.array("zone").alias("z"), F.array("source_name").alias("s"))
    out = M.union_lists(rows, ["indicator_id"], "z", "seq").join(M.union_lists(rows, ["indicator_id"], "s", "seq"), "indicator_id")
    return out.select("indicator_id", F.array_join("z", "|").alias("zones"), F.array_join("s", "|").alias("sources"))


@query("E2b_deactivation", "SELECT malware_id AS campaign FROM malware WHERE malware_id NOT IN (SELECT malware_id FROM attribute WHERE active AND seen >= TIMESTAMP '2001-10-25')")
def deactivation(t):
    linked = t.attribute.select(F.col("malware_id").alias("campaign"), (F.col("active") & (F.col("seen") >= F.lit("2001-10-25").cast("timestamp"))).alias("active"))
    return E.inactive_campaigns(t.malware.select(F.col("malware_id").alias("campaign")), linked, "campaign")


@query("P18_P19_trust", """WITH r AS (SELECT event_id, idx, source_name, CASE WHEN idx % 2 = 0 THEN 'u-' || lower(zone) END AS creator_uuid, CASE idx % 3 WHEN 0 THEN ' nvd ' WHEN 1 THEN 'ELSEWHERE' END AS creator_name,
    CASE WHEN idx % 4 = 0 THEN seen END AS own, CASE WHEN idx % 4 = 1 THEN seen + INTERVAL 1 DAY END AS nvd, seen + INTERVAL 2 DAY AS fox FROM attribute),
  d AS (SELECT *, CASE WHEN creator_uuid = 'u-energy' THEN 'uuid' WHEN lower(trim(creator_name)) = 'nvd' THEN 'name' WHEN creator_uuid IS NULL AND creator_name IS NULL THEN 'no creator' ELSE 'unknown creator' END AS reason FROM r)
  SELECT event_id, idx, reason IN ('uuid', 'name') AS trusted, reason, CASE WHEN reason IN ('uuid', 'name') AND source_name IN ('NVD', 'CISA-KEV') THEN epoch_us(coalesce(own, nvd, fox)) // 1000000 END AS first FROM d""")
def trust(t):
    day = F.expr("INTERVAL 1 DAY")
    k = F.col("idx")
    rows = t.attribute.select("event_id", "idx", "source_name", F.when(k % 2 == 0, F.concat(F.lit("u-"), F.lower("zone"))).alias("creator_uuid"), F.when(k % 3 == 0, F.lit(" nvd ")).when(k % 3 == 1, F.lit("ELSEWHERE")).alias("creator_name"),
                              F.when(k % 4 == 0, F.col("seen")).alias("own"), F.when(k % 4 == 1, F.col("seen") + day).alias("nvd"), (F.col("seen") + day + day).alias("fox"))
    allow = t.spark.createDataFrame([("u-energy", "Energy Org"), ("u-none", "NVD")], "uuid string, name string")
    told = E.creator_trust(rows, allow)
    first = E.truthful_time(F.col("source_name"), F.col("trusted"), ["NVD", "CISA-KEV"], ["own", "nvd", "fox"])
    return told.select("event_id", "idx", "trusted", "reason", F.unix_timestamp(first).alias("first"))


@query("T9_ranks", """SELECT label, rank, chunk, count(*) AS n FROM (SELECT 'Indicator' AS label, 5 AS rank, indicator_id // 500 AS chunk FROM indicator UNION ALL SELECT 'Malware', 2, malware_id // 500 FROM malware UNION ALL SELECT 'ThreatActor', 3, actor_id // 500 FROM actor
  UNION ALL SELECT 'Other', 6, c_custkey // 500 FROM customer) x GROUP BY label, rank, chunk""")
def ranks(t):
    """Work in the order of label ranks and stable chunks: a chunk is a range of ids, so no label is sorted in one task."""
    parts = [df.select(F.lit(label).alias("label"), F.col(c).cast("long").alias("id")) for label, df, c in (("Indicator", t.indicator, "indicator_id"), ("Malware", t.malware, "malware_id"), ("ThreatActor", t.actor, "actor_id"), ("Other", t.customer, "c_custkey"))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return rows.select("label", M.label_rank(F.col("label")).alias("rank"), F.floor(F.col("id") / 500).alias("chunk")).groupBy("label", "rank", "chunk").agg(F.count("*").alias("n"))


@query("P21_P24_clean", "SELECT doc_id, CASE WHEN length(v) > 255 THEN left(v, 252) || '...' ELSE v END AS value, trim(coalesce(text, '')) <> '' AND strlen(coalesce(text, '')) <= 4096 AS accepted FROM (SELECT doc_id, text, trim(regexp_replace(coalesce(text, ''), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g')) AS v FROM documents) x")
def clean(t):
    return t.documents.select("doc_id", S.clean_value(F.col("text")).alias("value"), S.accepted_value(F.col("text")).alias("accepted"))
