"""Change sets: what must be inserted, updated and deleted so that stored rows become the wanted ones, and what two copies of a graph differ in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def digest(columns: list[str]) -> Column:
    """A hash of columns in the order of their names, NULL told from any value."""
    named = sorted(columns)
    return F.xxhash64(F.lit(0), *named, *[F.col(c).isNull() for c in named])


def diff(wanted: DataFrame, stored: DataFrame, keys: list[str], columns: list[str] | None = None, prune: bool = True) -> DataFrame:
    """(keys, columns of the wanted row, op) of rows that are not as wanted: ``insert``, ``update`` (a column differs) and, with ``prune``, ``delete``
    (columns are NULL). Both sides are rows by key; a key with a NULL is left out. One full join, which only changed rows leave."""
    columns = columns or []
    new = wanted.dropna(subset=keys).select(*keys, *columns, F.lit(True).alias("__n"), digest(columns).alias("__nd"))
    old = stored.dropna(subset=keys).select(*keys, F.lit(True).alias("__o"), digest(columns).alias("__od"))
    j = new.join(old, keys, "full")
    op = F.when(F.col("__o").isNull(), "insert").when(F.col("__n").isNull(), "delete" if prune else None).when(F.col("__nd") != F.col("__od"), "update")
    return j.withColumn("op", op).where(F.col("op").isNotNull()).select(*keys, *columns, "op")


def applied(stored: DataFrame, changes: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """Stored rows after a change set."""
    columns = columns or []
    kept = stored.select(*keys, *columns).join(changes.select(*keys), keys, "left_anti")
    return kept.unionByName(changes.where("op <> 'delete'").select(*keys, *columns))


def campaign_links(attributed: DataFrame, indicates: DataFrame, indicators: DataFrame, most: int = 100) -> DataFrame:
    """Wanted PART_OF links (campaign, label, member): each attributed malware, and the newest ``most`` active indicators by first import, ties by
    value, an indicator once. attributed: malware, actor; indicates: indicator, malware; indicators: indicator, value, active, first_seen.
    The cut of a campaign is made before rows are dealt by campaign and again after, so a campaign with most indicators is no large group."""
    owned, name = attributed.select("malware", "actor").distinct(), F.concat("actor", F.lit(" Campaign")).alias("campaign")
    pairs = owned.join(indicates.select("indicator", "malware").distinct(), "malware").select("actor", "indicator").distinct()
    live = pairs.join(indicators.where("active").select("indicator", "value", "first_seen"), "indicator")
    rank = F.row_number().over(Window.partitionBy("actor").orderBy(F.col("first_seen").desc_nulls_first(), "value", "indicator"))
    top = live.withColumn("__r", rank).where(F.col("__r") <= most)
    text = lambda c: F.col(c).cast("string").alias("member")
    return owned.select(name, F.lit("Malware").alias("label"), text("malware")).unionByName(top.select(name, F.lit("Indicator").alias("label"), text("indicator")))


def link_changes(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """Change set of PART_OF links (campaign, label, member). Links of indicators that are no longer wanted go; links of malware stay."""
    keys, malware = ["campaign", "label", "member"], F.col("label") == "Malware"
    parts = [diff(wanted.where(w), stored.where(w), keys, prune=p) for w, p in ((malware, False), (~malware, True))]
    return reduce(DataFrame.unionByName, parts)


def activity_changes(nodes: DataFrame, node_events: DataFrame, active_events: DataFrame, key: str) -> DataFrame:
    """(key, active) of nodes whose flag changes: active if one of their events is. Nodes without events and retired ones stay; without any
    active event nothing changes, so a failed listing does not switch off the graph. nodes: key, active, retired_at."""
    events = active_events.select("event_id").distinct().withColumn("__a", F.lit(True))
    hit = node_events.select(key, "event_id").distinct().join(events, "event_id", "left").groupBy(key).agg(F.max("__a").isNotNull().alias("__hit"))
    some = active_events.select("event_id").limit(1).withColumn("__some", F.lit(True)).select("__some")
    j = nodes.where("retired_at IS NULL").join(hit, key).where(~F.col("active").eqNullSafe(F.col("__hit")))
    return j.join(F.broadcast(some)).select(key, F.col("__hit").alias("active"))  # one row or none


def delta(here: DataFrame, there: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, status) of two copies by key, which must hold the label: twins share an id. ``changed`` where a digest over the sorted columns differs,
    ``only here``, ``only there`` and ``same``."""
    a = here.dropna(subset=keys).select(*keys, digest(columns).alias("__a"))
    b = there.dropna(subset=keys).select(*keys, digest(columns).alias("__b"))
    status = F.when(F.col("__b").isNull(), "only here").when(F.col("__a").isNull(), "only there").when(F.col("__a") != F.col("__b"), "changed").otherwise("same")
    return a.join(b, keys, "full").select(*keys, status.alias("status"))
