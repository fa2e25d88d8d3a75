"""The asset graph with all its labels and edge kinds, edges written one at a time, backfills and analysts' queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import merge as M
from ..operators import serve as V
from ..operators import topology as TP
from .catalog import query

#: The key that a node of each label takes from a part: every third is blank.
_KEYED = {label: n for n, label in enumerate(TP.NODE_KEYS)}
_KEY = "CASE WHEN (p_partkey + {n}) % 3 > 0 THEN 'k' || (p_partkey // (2 + {n} % 3))::VARCHAR ELSE '{blank}' END"
_DOMAIN = "CASE WHEN p_size % 2 = 0 THEN 'default' ELSE 'd' END"


def _label_sql(label: str, n: int) -> str:
    second = _DOMAIN if label == "User" else ("p_size::VARCHAR" if len(TP.NODE_KEYS[label]) > 1 else "''")
    return f"SELECT '{label}' AS label, {_KEY.format(n=n, blank='')} AS key, {second} AS second, max_by(p_brand, p_partkey) AS note FROM part WHERE (p_partkey + {n}) % 3 > 0 GROUP BY 1, 2, 3"


@query("TOPOLOGY_all_labels", " UNION ALL ".join(_label_sql(label, n) for label, n in _KEYED.items()))
def all_labels(t):
    """Upserts of every asset label by its natural key."""
    out = []
    for label, n in _KEYED.items():
        keys, c = TP.NODE_KEYS[label], F.col("p_partkey")
        cells = {keys[0]: F.when((c + n) % 3 > 0, F.concat(F.lit("k"), F.floor(c / (2 + n % 3)).cast("string"))).otherwise(" ")}
        if label == "User":
            cells["domain"] = F.when(F.col("p_size") % 2 == 0, " ").otherwise("d")
        elif len(keys) > 1:
            cells[keys[1]] = F.col("p_size").cast("string")
        claims = t.part.select(*[v.alias(k) for k, v in cells.items()], F.col("p_brand").alias("note"), c.alias("seq"))
        rows = TP.merge_assets(label, claims, "seq", ["note"])
        out.append(rows.select(F.lit(label).alias("label"), F.col(keys[0]).alias("key"), (F.col(keys[1]) if len(keys) > 1 else F.lit("")).alias("second"), "note"))
    return reduce(DataFrame.unionByName, out)


_KINDS = [*TP.EDGES, ("Host", "NEAR", "Host")]
_VALUES = ", ".join(f"('{s}', '{k}', '{g}')" for s, k, g in _KINDS)


@query("TOPOLOGY_all_kinds", f"""WITH k(src_label, type, trg_label) AS (VALUES {_VALUES}), c AS (SELECT DISTINCT s_suppkey AS src, s_nationkey AS trg FROM supplier)
  SELECT src_label, type, trg_label, src::VARCHAR AS src, trg::VARCHAR AS trg FROM k, c WHERE type <> 'NEAR' AND (src + length(src_label)) % 4 > 0 AND (trg + length(trg_label)) % 4 > 0""")
def all_kinds(t):
    """Claims of every edge kind, and of one that is not allowed, in one linking job."""
    kinds = F.array(*[F.struct(F.lit(s).alias("src_label"), F.lit(k).alias("type"), F.lit(g).alias("trg_label")) for s, k, g in _KINDS])
    ends = t.supplier.select(F.col("s_suppkey").cast("string").alias("src"), F.col("s_nationkey").cast("string").alias("trg"))
    claims = ends.select("src", "trg", F.inline(kinds))
    labels = F.array(*[F.lit(x) for x in TP.NODE_KEYS])
    keys = ends.select("src").unionByName(ends.select(F.col("trg").alias("src"))).distinct()
    nodes = keys.select(F.explode(labels).alias("label"), F.col("src").alias("key")).where((F.col("key").cast("int") + F.length("label")) % 4 > 0)
    return TP.link_all(claims, nodes)


_ENDS = [("indicator", "INDICATES", "malware", "indicator_id", "malware_id", 0.6), ("indicator", "TARGETS", "sector", "indicator_id", "zone", 0.5), ("malware", "LIKES", "sector", "malware_id", "zone", None)]


@query("M9_single_edges", " UNION ALL ".join(f"SELECT '{s}' AS src_kind, '{k}' AS type, '{g}' AS trg_kind, {a}::VARCHAR AS src, {b}::VARCHAR AS trg, {v}e0 AS confidence, string_agg(DISTINCT source_name, '|' ORDER BY source_name) AS sources, count(DISTINCT event_id) AS events FROM attribute WHERE {b}::VARCHAR <> 'telecom' GROUP BY 4, 5" for s, k, g, a, b, v in _ENDS if v))
def single_edges(t):
    blank = lambda c: F.when(F.col(c).cast("string") == "telecom", " ").otherwise(F.col(c).cast("string"))
    parts = [t.attribute.select(F.lit(s).alias("src_kind"), F.lit(k).alias("type"), F.lit(g).alias("trg_kind"), F.col(a).cast("string").alias("src"), blank(b).alias("trg"), F.col("source_name").alias("source"), F.array(F.col("event_id").cast("string")).alias("event_ids"), "seq") for s, k, g, a, b, _ in _ENDS]
    out = M.single_edges(reduce(DataFrame.unionByName, parts), "seq")
    return out.select("src_kind", "type", "trg_kind", "src", "trg", "confidence", F.array_join("sources", "|").alias("sources"), F.size("event_ids").cast("long").alias("events"))


@query("E8_date_backfill", "SELECT v.cve_id, coalesce(v.kev_added, min(strftime(a.seen, '%Y-%m-%d'))) AS added FROM vulnerability v LEFT JOIN indicator i ON i.cve_id = v.cve_id LEFT JOIN attribute a ON a.indicator_id = i.indicator_id GROUP BY v.cve_id, v.kev_added")
def date_backfill(t):
    told = t.attribute.select("indicator_id", F.date_format("seen", "yyyy-MM-dd").alias("kev_added")).join(t.indicator.select("indicator_id", "cve_id").dropna(), "indicator_id")
    return M.fill_missing(t.vulnerability.select("cve_id", "kev_added"), told, "cve_id", ["kev_added"]).withColumnRenamed("kev_added", "added")


@query("A13_samples", "SELECT b AS label, count(*) AS total, array_to_string(list_sort(list(DISTINCT v))[1:5], '|') AS sample FROM (SELECT p_brand AS b, p_type AS v FROM part WHERE p_size % 2 = 0) x GROUP BY b")
def name_samples(t):
    return V.samples(t.part.where("p_size % 2 = 0").select(F.col("p_brand").alias("label"), F.col("p_type").alias("v")), "label", "v")


_SINCE = "(SELECT max(seen) - INTERVAL 7 DAY FROM attribute)"


@query("Q21_zones_of_week", f"SELECT zone, count(DISTINCT indicator_id) AS indicators FROM attribute WHERE seen >= {_SINCE} GROUP BY zone")
def zones_of_week(t):
    newest = F.broadcast(t.attribute.agg((F.max("seen") - F.expr("INTERVAL 7 DAYS")).alias("since")))
    return t.attribute.select("zone", "indicator_id", "seen").join(newest, F.col("seen") >= F.col("since")).groupBy("zone").agg(F.countDistinct("indicator_id").alias("indicators"))


@query("Q21_both_zones", "SELECT indicator_id FROM attribute GROUP BY indicator_id HAVING bool_or(zone = 'energy') AND bool_or(zone = 'finance')")
def both_zones(t):
    z = t.attribute.where(F.col("zone").isin("energy", "finance")).groupBy("indicator_id").agg(F.min("zone").alias("a"), F.max("zone").alias("b"))
    return z.where("a <> b").select("indicator_id")


@query("Q21_phase_actors", "SELECT t.p AS phase, count(DISTINCT a.actor_id) AS actors FROM (SELECT actor_id, unnest(split(uses_techniques, ';')) AS m FROM actor) a JOIN (SELECT DISTINCT mitre_id, lower(unnest(split(tactic_phases, ';'))) AS p FROM technique) t ON t.mitre_id = a.m GROUP BY t.p")
def phase_actors(t):
    uses = t.actor.select("actor_id", F.explode(F.split("uses_techniques", ";")).alias("mitre_id")).distinct()
    phases = t.technique.select("mitre_id", F.explode(F.split(F.lower("tactic_phases"), ";")).alias("phase")).distinct()
    return uses.join(phases, "mitre_id").groupBy("phase").agg(F.countDistinct("actor_id").alias("actors"))


@query("Q21_retired_by_actor", "SELECT m.nationkey AS actor_id, count(DISTINCT l.indicator_id) FILTER (NOT l.active) AS retired, count(DISTINCT l.indicator_id) FILTER (l.active) AS live FROM live l JOIN indicates i ON i.indicator_id = l.indicator_id JOIN malware m ON m.malware_id = i.malware_id GROUP BY m.nationkey")
def retired_by_actor(t):
    near = t.indicates.join(t.malware.select("malware_id", F.col("nationkey").alias("actor_id")), "malware_id").select("actor_id", "indicator_id").distinct()
    state = near.join(t.live.select("indicator_id", "active"), "indicator_id")
    return state.groupBy("actor_id").agg(F.count_if(~F.col("active")).alias("retired"), F.count_if(F.col("active")).alias("live"))
