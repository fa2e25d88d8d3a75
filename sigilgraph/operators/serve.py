"""Serving queries: filters, pages, counts, neighbourhoods, collapses and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("nodes")).select(F.lit(k).alias("label"), "nodes") for k, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def member_counts(nodes: DataFrame, members: Column, key: str, name: str) -> DataFrame:
    """Distinct nodes for each member of a list column, exact."""
    return nodes.select(key, F.explode(members).alias(name)).groupBy(name).agg(F.countDistinct(key).alias("nodes"))


def combination_counts(nodes: DataFrame, zones: str) -> DataFrame:
    """Nodes for each combination of zones, whatever their order."""
    combo = F.array_join(F.array_sort(F.array_distinct(zones)), "+")
    return nodes.groupBy(combo.alias("zones")).agg(F.count("*").alias("nodes"))


def edge_statistics(edges: DataFrame) -> DataFrame:
    return edges.groupBy("type").agg(F.count("*").alias("edges"), F.round(F.avg("confidence"), 6).alias("avg_confidence"))


def page(rows: DataFrame, by: str, key: str, limit: int, offset: int = 0, most: int = 500) -> DataFrame:
    """Rows by ``by``, highest first and NULL before all, ties by key; limits as the service caps them."""
    return rows.orderBy(F.col(by).desc_nulls_first(), key).offset(min(max(offset, 0), 100_000)).limit(min(max(limit, 1), most))


def keyset_page(rows: DataFrame, key: str, after: str, limit: int) -> DataFrame:
    return rows.where(F.col(key) > after).orderBy(key).limit(limit)


def neighbours(edges: DataFrame, ids: DataFrame, most: int = 10) -> DataFrame:
    """Up to ``most`` neighbours of each id, in either direction, in order of type and id. edges: src, trg, type; ids: id."""
    both = edges.select(F.col("src").alias("id"), F.col("trg").alias("other"), "type").unionByName(edges.select(F.col("trg").alias("id"), F.col("src").alias("other"), "type"))
    near = both.join(ids, "id", "left_semi").distinct()
    from .link import capped

    return capped(near, ["id"], ["type", "other"], most)


def collapse_twins(rows: DataFrame) -> DataFrame:
    """One row for each cve_id out of twin labels: best score, first severity and description (Vulnerability before CVE), all zones.
    rows: label, cve_id, score, severity, description, zones array, kev_added."""
    order = F.when(F.col("label") == "Vulnerability", 0).otherwise(1)
    pick = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), order))
    out = rows.groupBy("cve_id").agg(F.max("score").alias("score"), pick("severity").alias("severity"), F.left(pick("description"), F.lit(200)).alias("description"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("zones")))).alias("zones"), (F.max("kev_added").isNotNull()).alias("is_kev"))
    return out.orderBy(F.coalesce("score", F.lit(0.0)).desc(), "cve_id")


def answer(question: str, nodes: DataFrame, zone: str | None = None) -> DataFrame:
    """Nodes (label, key, name, type, severity, score, zones array, managed) that a question in plain words asks for: its words choose
    labels, severity and type; a question with none of them is about all labels."""
    q = question.lower()
    has = lambda *words: any(w in q for w in words)
    labels, more = ["Indicator", "Vulnerability", "CVE", "Malware", "ThreatActor", "Technique", "Campaign"], F.lit(True)
    if has("cve", "vulnerability", "cvss"):
        labels = ["Vulnerability", "CVE"]
        if has("high", "critical"):
            more = F.col("severity").isin("HIGH", "CRITICAL") | (F.col("score") >= 7)
        elif has("medium", "low"):
            more = F.col("severity") == ("MEDIUM" if has("medium") else "LOW")
    elif has("actor", "apt", "threat group"):
        labels = ["ThreatActor"]
    elif has("indicator", "ip", "domain", "hash", "malicious"):
        labels = ["Indicator"]
        kind = next((k for w, k in (("ip", "ipv4"), ("domain", "domain"), ("hash", "hash")) if w in q), None)
        more = F.col("type") == kind if kind else more
    rows = nodes.where(F.col("label").isin(labels) & more & F.coalesce("managed", F.lit(False)))
    return rows.where(F.array_contains("zones", zone)) if zone else rows


def effective_score(node: Column, v31: Column, v30: Column, v2: Column, v40: Column) -> Column:
    """The first score that is there, in this order; 0.0 is a score."""
    return F.coalesce(node, v31, v30, v2, v40)


def severity_filter(level: str, severity: Column, score: Column) -> Column:
    if level in ("high", "critical"):
        return severity.isin("HIGH", "CRITICAL") | (score >= 7.0)
    return severity == level.upper()


def top_counts(rows: DataFrame, by: str, limit: int = 10) -> DataFrame:
    return rows.groupBy(by).agg(F.count("*").alias("nodes")).orderBy(F.desc("nodes"), by).limit(limit)


def without_edges(nodes: DataFrame, key: str, edges: DataFrame) -> DataFrame:
    ends = edges.select(F.col("src").alias(key)).unionByName(edges.select(F.col("trg").alias(key))).distinct()
    return nodes.join(ends, key, "left_anti")


def recent_runs(runs: DataFrame, group: str, order: str, most: int = 10) -> DataFrame:
    """Success share and average duration of the last runs, total of all."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.col(order).desc(), "run_id"))
    marked = runs.withColumn("__n", rank)
    last = F.col("__n") <= most
    return marked.groupBy(group).agg(F.count("*").alias("runs"), F.round(F.avg(F.col("ok").cast("double")), 6).alias("success"), F.round(F.avg(F.when(last, F.col("seconds"))), 6).alias("avg_recent"))


def audit(nodes: DataFrame, label: str, node_id: str, managed: str, events: str) -> DataFrame:
    """For each label: nodes, those without an id, those not managed (NULL or false), and those without events to backfill from."""
    unmanaged = ~F.coalesce(F.col(managed), F.lit(False))
    return nodes.groupBy(label).agg(F.count("*").alias("nodes"), F.count_if(F.col(node_id).isNull()).alias("without_id"), F.count_if(unmanaged).alias("unmanaged"), F.count_if(F.col(events) == 0).alias("without_events"))


def samples(rows: DataFrame, group: str, value: str, most: int = 5) -> DataFrame:
    """(group, total, sample): count of rows and the first ``most`` distinct values of each group, joined by ``|``."""
    from .link import capped

    first = capped(rows.select(group, value).distinct(), [group], [value], most).groupBy(group).agg(F.array_join(F.array_sort(F.collect_list(value)), "|").alias("sample"))
    return rows.groupBy(group).agg(F.count("*").alias("total")).join(first, group)


# Versions of scores in the order in which they stand in for a node's own.
SCORE_VERSIONS = ["v31", "v30", "v2", "v40"]


def with_scores(nodes: DataFrame, children: DataFrame) -> DataFrame:
    """Nodes (cve_id, score, severity) with score and severity as they are shown and a struct (base_score, base_severity, vector_string) for each version,
    NULL without one. children: cve_id, version and these; one of each version, else the greatest. A node's own score comes with its own
    severity; else the first version that has a score decides, with the node's severity if it names none."""
    fields = ["base_score", "base_severity", "vector_string"]
    each = children.groupBy("cve_id").agg(*[F.max(F.when(F.col("version") == v, F.struct(*fields))).alias(v) for v in SCORE_VERSIONS])
    j = nodes.join(each, "cve_id", "left")
    first = F.coalesce(*[F.when(F.col(v)["base_score"].isNotNull(), F.col(v)) for v in SCORE_VERSIONS])
    own = F.col("score").isNotNull()
    return j.withColumns({"score": F.coalesce("score", first["base_score"]), "severity": F.when(own, F.col("severity")).otherwise(F.coalesce(first["base_severity"], "severity"))})


def zone_threats(nodes: DataFrame, limit: int = 10, severity: str | None = None) -> DataFrame:
    """(zone, rank, label, key): the newest ``limit`` (1 to 100) managed nodes of every zone, of all labels, NULL times first, optionally of one severity. nodes:
    label, key, severity, zones, last_updated, managed. All zones in one pass, each cut before its rows are gathered."""
    from pyspark.sql import Window

    rows = nodes.where("managed").select("label", "key", "severity", "last_updated", F.explode(F.array_distinct("zones")).alias("zone"))
    rows = rows if severity is None else rows.where(F.col("severity") == severity.upper())
    rank = F.row_number().over(Window.partitionBy("zone").orderBy(F.col("last_updated").desc_nulls_first(), "label", "key"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= min(max(limit, 1), 100)).select("zone", "rank", "label", "key")


def zone_summary(nodes: DataFrame) -> DataFrame:
    """(zone, total, critical, high, medium, low) of managed nodes of all labels."""
    rows = nodes.where("managed").select("severity", F.explode(F.array_distinct("zones")).alias("zone"))
    level = lambda s: F.count_if(F.coalesce(F.col("severity") == s, F.lit(False))).alias(s.lower())
    return rows.groupBy("zone").agg(F.count("*").alias("total"), *map(level, ("CRITICAL", "HIGH", "MEDIUM", "LOW")))


def active_nodes(nodes: DataFrame, events: DataFrame, keys: list[str]) -> DataFrame:
    """Nodes that are active or do not say and that some event names. events: the keys and event_id."""
    return nodes.where(F.coalesce("active", F.lit(True))).join(events.where("event_id IS NOT NULL").select(*keys).distinct(), keys, "left_semi")
