"""Enrichment jobs: bridge, campaigns, calibration, decay, activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ident import folded
from ..functions.scalars import RETIRE_AFTER, days_between, decay_tier, decayed, event_tier, zone_fold
from ..session import materialize


def bridge(vulnerabilities: DataFrame, cves: DataFrame) -> DataFrame:
    """REFERS_TO edges in both directions between twins with the same cve_id."""
    ids = vulnerabilities.select("cve_id").distinct().join(cves.select("cve_id").distinct(), "cve_id", "left_semi")
    ways = F.explode(F.array(F.struct(F.lit("Vulnerability").alias("a"), F.lit("CVE").alias("b")), F.struct(F.lit("CVE").alias("a"), F.lit("Vulnerability").alias("b"))))
    return ids.withColumn("w", ways).select(F.col("w.a").alias("src_label"), F.col("w.b").alias("trg_label"), "cve_id")


def campaigns(attributed: DataFrame, indicates: DataFrame, indicators: DataFrame, sourced: DataFrame | None = None) -> DataFrame:
    """One campaign for each actor with malware and an active indicator.

    attributed (malware, actor), indicates (indicator, malware), indicators (indicator, active, first_seen, last_seen, zones array),
    sourced (indicator, first, last): per-source times, folded to one row for each indicator before any join, so that no join
    multiplies rows.
    """
    live = indicators.where(F.col("active"))
    if sourced is not None:
        times = sourced.groupBy("indicator").agg(F.min("first").alias("__f"), F.max("last").alias("__l"))
        live = live.join(times, "indicator", "left").withColumns({"first_seen": F.coalesce("__f", "first_seen"), "last_seen": F.coalesce("__l", "last_seen")}).drop("__f", "__l")
    pairs = indicates.select("indicator", "malware").distinct()
    owned = attributed.select("malware", "actor").distinct()
    # Actor and indicator meet through many malware: the pair is made distinct before anything is counted.
    members = owned.join(pairs, "malware").select("actor", "indicator").distinct().join(live, "indicator")
    per_actor = members.groupBy("actor").agg(F.count("*").alias("indicator_count"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), zone_fold(F.flatten(F.collect_set("zones"))).alias("zone"))
    malware = owned.groupBy("actor").agg(F.count("*").alias("malware_count"))
    return per_actor.join(malware, "actor").withColumn("name", F.concat("actor", F.lit(" Campaign")))


def top_members(attributed: DataFrame, indicates: DataFrame, indicators: DataFrame, most: int = 100) -> DataFrame:
    """The newest ``most`` active indicators of each campaign, an indicator once, ties by value."""
    pairs = attributed.select("malware", "actor").distinct().join(indicates.select("indicator", "malware").distinct(), "malware").select("actor", "indicator").distinct()
    rows = pairs.join(indicators.where(F.col("active")).select("indicator", "value", "first_seen"), "indicator")
    rank = F.row_number().over(Window.partitionBy("actor").orderBy(F.col("first_seen").desc_nulls_first(), "value"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= most)


def event_sizes(indicator_events: DataFrame) -> DataFrame:
    """Distinct indicators of each event (indicator, event_id)."""
    return indicator_events.groupBy("event_id").agg(F.countDistinct("indicator").alias("size"))


def calibrate(edges: DataFrame, indicator_events: DataFrame) -> DataFrame:
    """Confidence of co-occurrence edges by the largest event of their indicator; other edges stay. Edges: indicator, trg, sources, confidence."""
    largest = indicator_events.join(event_sizes(indicator_events), "event_id").groupBy("indicator").agg(F.max("size").alias("__size"))
    weak = F.exists("sources", lambda s: F.contains(s, F.lit("cooccurrence")) | F.contains(s, F.lit("correlation")))
    j = edges.join(largest, "indicator", "left")
    hit = F.coalesce(weak, F.lit(False)) & F.col("__size").isNotNull()
    return j.withColumns({"confidence": F.when(hit, event_tier(F.col("__size"))).otherwise(F.col("confidence")), "calibrated": hit}).drop("__size")


def decay(nodes: DataFrame, label: str, seen: str, as_of: Column) -> DataFrame:
    """Age tiers by plain days since ``seen``: confidence falls once for each tier (last_decayed_tier), nodes older than a year retire.
    A NULL time does not age. Nodes: confidence, active, last_decayed_tier."""
    age, tier = days_between(F.col(seen), as_of), F.col("__tier")
    fresh = tier.isNotNull() & (tier != "retired") & ~tier.eqNullSafe(F.col("last_decayed_tier"))
    out = nodes.withColumn("__age", age).withColumn("__tier", decay_tier(F.col("__age")))
    retire = F.coalesce(F.col("__age") > RETIRE_AFTER, F.lit(False))
    return out.withColumns({"confidence": F.when(fresh, decayed(label, F.col("confidence"), F.col("__age"))).otherwise(F.col("confidence")), "active": F.col("active") & ~retire, "last_decayed_tier": F.coalesce(tier, "last_decayed_tier")}).drop("__age", "__tier")


def mark_activity(node_events: DataFrame, nodes: DataFrame, active_events: DataFrame, key: str) -> DataFrame:
    """active: whether one of a node's events is active. Nodes without events and retired nodes stay as they are; an empty set of active
    events changes nothing. node_events (key, event_id), active_events (event_id)."""
    hit = node_events.join(active_events.select("event_id").distinct().withColumn("__a", F.lit(1)), "event_id", "left").groupBy(key).agg((F.max("__a").isNotNull()).alias("__hit"))
    some = active_events.limit(1).agg((F.count("*") > 0).alias("__some"))
    j = nodes.join(hit, key, "left").join(F.broadcast(some))  # one row
    change = F.col("__some") & F.col("__hit").isNotNull() & F.col("retired_at").isNull()
    return j.withColumn("active", F.when(change, F.col("__hit")).otherwise(F.col("active"))).drop("__hit", "__some")


def enrichment_candidates(nodes: DataFrame, most: int = 100) -> DataFrame:
    """Nodes worth a look elsewhere: confidence below 0.8 or fewer than two sources."""
    return nodes.where((F.col("confidence") < 0.8) | (F.col("n_sources") < 2)).orderBy("confidence", "key").limit(most)


def inactive_campaigns(campaigns: DataFrame, linked: DataFrame, key: str) -> DataFrame:
    """Campaigns with no active linked indicator (left anti)."""
    return campaigns.select(key).distinct().join(linked.where("active").select(key).distinct(), key, "left_anti")


def creator_trust(rows: DataFrame, allow: DataFrame) -> DataFrame:
    """``rows`` (with creator_uuid, creator_name) and trusted, reason: a creator is looked up in ``allow`` (uuid, name) by uuid, then by
    name, as NFKC and case folding make it. The allow list is joined by key, so its size does not matter."""
    fold = lambda c: folded(F.col(c))
    ids = allow.select(F.col("uuid").alias("creator_uuid")).dropna().distinct().withColumn("__u", F.lit(True))
    names = allow.select(fold("name").alias("__name")).dropna().distinct().withColumn("__n", F.lit(True))
    out = rows.join(ids, "creator_uuid", "left").withColumn("__name", fold("creator_name")).join(names, "__name", "left")
    none = F.col("creator_uuid").isNull() & F.col("creator_name").isNull()
    reason = F.when(F.col("__u"), "uuid").when(F.col("__n"), "name").when(none, "no creator").otherwise("unknown creator")
    return out.withColumns({"reason": reason, "trusted": reason.isin("uuid", "name")}).drop("__u", "__n", "__name")


def truthful_time(source: Column, trusted: Column, sources: list[str], fields: list[str]) -> Column:
    """A time that a source reports itself: the first of ``fields`` (the attribute's own, then those of its META) that is there, for allowed
    sources of trusted creators; else NULL."""
    return F.when(trusted & source.isin(sources), F.coalesce(*fields))


# Patterns of edges that lack events: name, edge type, match type (None: any), and whose events they take: those that both ends
# share, or those of the source.
BACKFILL = [
    ("indicates_cooccurrence", "INDICATES", "misp_cooccurrence", "shared"), ("indicates_family_match", "INDICATES", "malware_family", "source"), ("exploits", "EXPLOITS", None, "source"),
    ("targets_indicator_to_sector", "TARGETS", None, "source"), ("affects_vuln_to_sector", "AFFECTS", None, "source"),
]

#: Rows that an event of no more than some 1000 pairs of ends may have; one with more is crowded.
CROWDED = 64


def backfill_events(edges: DataFrame, edge_events: DataFrame, node_events: DataFrame, most: int = 200) -> DataFrame:
    """(pattern, type, src_label, src, trg_label, trg, event_id): the first ``most`` events by ``at`` (ties by id) for each edge of a known pattern
    that has none yet; edges whose ends have no (shared) events get none.

    edges: type, src_label, src, trg_label, trg, match_type; edge_events: type, src_label, src, trg_label, trg; node_events: label, key, event_id, at.
    Where the source's events serve, they are cut once a node, before the node's edges multiply them. Shared ones are found by event."""
    from .link import capped

    ends = ["type", "src_label", "src", "trg_label", "trg"]
    fits = lambda t, m: (F.col("type") == t) & (F.lit(True) if m is None else F.coalesce(F.col("match_type") == m, F.lit(False)))
    pattern = F.coalesce(*[F.when(fits(t, m), F.struct(F.lit(n).alias("pattern"), F.lit(how).alias("how"))) for n, t, m, how in BACKFILL])
    gap = edges.select(*ends, pattern.alias("p")).where("p IS NOT NULL").distinct().join(edge_events.select(*ends).distinct(), ends, "left_anti").select("p.pattern", "p.how", *ends)
    gap = materialize(gap, "gaps")
    both, told = gap.where("how = 'shared'"), node_events.where("event_id IS NOT NULL")

    def of(p, gaps):
        """Events of nodes with labels that ends of these gaps have."""
        labels = F.broadcast(gaps.select(F.col(f"{p}_label").alias("label")).distinct())  # a row for each label
        return told.join(labels, "label", "left_semi").select(F.col("label").alias(f"{p}_label"), F.col("key").alias(p), "event_id", *(["at"] if p == "src" else []))

    events = lambda df: df.groupBy("src_label", "src", "event_id").agg(F.min("at").alias("at"))
    alone = gap.where("how = 'source'")
    alone = alone.join(capped(events(of("src", alone)), ["src_label", "src"], ["at", "event_id"], most), ["src_label", "src"])
    ours = {"src": of("src", both), "trg": of("trg", both).join(both.select("trg_label", "trg").distinct(), ["trg_label", "trg"], "left_semi").distinct()}
    # Ends meet in an event, which has few rows. Only in crowded events each edge brings its source's, as such an event's pairs are too many.
    crowded = materialize(told.groupBy("event_id").agg(F.count("*").alias("n")).where(F.col("n") > CROWDED).select("event_id"), "crowded-events")
    hot = crowded.limit(1).count() > 0
    calm = ours["src"].join(crowded, "event_id", "left_anti") if hot else ours["src"]
    shared = calm.join(ours["trg"], "event_id").join(both, ["src_label", "src", "trg_label", "trg"]).select("pattern", *ends, "event_id", "at")
    if hot:
        there = {p: df.join(crowded, "event_id", "left_semi") for p, df in ours.items()}
        shared = shared.unionByName(both.join(events(there["src"]), ["src_label", "src"]).join(there["trg"], ["trg_label", "trg", "event_id"]).select(*shared.columns))
    shared = shared.groupBy("pattern", *ends, "event_id").agg(F.min("at").alias("at"))
    out = ["pattern", *ends, "event_id"]
    return alone.select(*out).unionByName(capped(shared, ends, ["at", "event_id"], most).select(*out))


def run_jobs(jobs: dict) -> DataFrame:
    """(step, ok, edges) of the enrichment jobs in their order: bridge, campaigns, calibration, decay, each a function of no arguments that gives the
    rows it changes. One that cannot be planned is reported, and the others go on. Raises ValueError for other names or another order."""
    from .link import build_links

    if list(jobs) != JOBS:
        raise ValueError(f"jobs run in the order {JOBS}")
    return build_links(jobs)


#: The order of jobs: campaigns read bridged edges, decay comes after confidences are calibrated.
JOBS = ["bridge", "campaigns", "calibration", "decay"]


def invariants(attributed: DataFrame, indicates: DataFrame, indicators: DataFrame, campaigns_: DataFrame, sourced: DataFrame) -> DataFrame:
    """One row of what must hold after a run: actors that qualify for a campaign (a malware with an active indicator), those of them without one
    (campaigns_: actor), numbers of indicators and of provenance edges, and ok: none is missing and neither number is zero."""
    live = indicators.where("active").select("indicator")
    due = attributed.select("malware", "actor").distinct().join(indicates.select("malware", "indicator").distinct(), "malware").join(live, "indicator", "left_semi").select("actor").distinct()
    marked = due.join(campaigns_.select("actor").distinct().withColumn("__c", F.lit(1)), "actor", "left")
    a = marked.agg(F.count("*").alias("qualifying"), F.count_if(F.col("__c").isNull()).alias("missing"))
    b, c = indicators.agg(F.count("*").alias("indicators")), sourced.agg(F.count("*").alias("sourced"))
    one = a.join(F.broadcast(b)).join(F.broadcast(c))  # a row each
    return one.withColumn("ok", (F.col("missing") == 0) & (F.col("indicators") > 0) & (F.col("sourced") > 0))
