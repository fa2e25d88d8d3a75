"""Upserts as aggregations: one ``groupBy`` on the key applies every column's own rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ident import is_placeholder, merge_name, merge_value
from ..functions.scalars import zone_fold


def union_lists(claims: DataFrame, keys: list[str], column: str, order: str) -> DataFrame:
    """(keys, column): distinct members of all claims' lists, in the order in which claims first name them. Members are made distinct before they are
    gathered, so a row holds what it shows and not a member for each claim. Ties by place in the list, then by member."""
    each = claims.select(*keys, F.col(order).alias("__o"), F.posexplode(column).alias("__p", "__m")).where(F.col("__m").isNotNull())
    first = each.groupBy(*keys, "__m").agg(F.min(F.struct("__o", "__p")).alias("__f"))
    return first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("__f", "__m"))), lambda x: x["__m"]).alias(column))


def last_value(column: str, order: str) -> Column:
    """The last value that is not NULL."""
    return F.max_by(column, F.when(F.col(column).isNotNull(), F.col(order)))


def first_value(column: str, order: str) -> Column:
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.col(order)))


def merge_nodes(claims: DataFrame, keys: list[str], order: str, *, highest=(), earliest=(), latest=(), first=(), last=(), sets=(), zones: str | None = None) -> DataFrame:
    """One row for each key. ``highest`` keeps the maximum (NULL and NaN lose), ``earliest`` and ``latest`` are times,
    ``first`` and ``last`` follow ``order`` and skip NULL, ``sets`` are sorted distinct array members, and ``zones`` is an array in
    which specific zones override ``global``. All rules are partial aggregates, so a hot key shrinks before the shuffle."""
    number = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c))
    members = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
    out = [F.max(number(c)).alias(c) for c in highest]
    out += [F.min(c).alias(c) for c in earliest] + [F.max(c).alias(c) for c in latest]
    out += [first_value(c, order).alias(c) for c in first] + [last_value(c, order).alias(c) for c in last]
    out += [members(c).alias(c) for c in sets]
    if zones:
        out.append(zone_fold(F.flatten(F.collect_set(zones))).alias(zones))
    named = claims.where(F.forall(F.array(*[F.trim(F.coalesce(F.col(k).cast("string"), F.lit(""))) for k in keys]), lambda x: x != ""))
    return named.groupBy(*keys).agg(*out) if out else named.select(*keys).distinct()


def merge_provenance(claims: DataFrame, node_keys: list[str], source: str, first: str, last: str, raw: str, order: str) -> DataFrame:
    """SOURCED_FROM edges: earliest first and latest last report of each source; raw data stays as first written."""
    return claims.groupBy(*node_keys, source).agg(F.min(first).alias(first), F.max(last).alias(last), first_value(raw, order).alias(raw), F.count("*").alias("claims"))


def merge_edges(claims: DataFrame, keys: list[str], order: str, existing: DataFrame | None = None) -> DataFrame:
    """Edges with the last writer's confidence, unless a calibrated edge is stored already: that one's stays. Sources and event ids
    accumulate. Claims: keys, confidence, match_type, source, event_ids; existing: the same and calibrated_at, sources."""
    new = claims.groupBy(*keys).agg(last_value("confidence", order).alias("confidence"), last_value("match_type", order).alias("match_type"), F.array_sort(F.collect_set("source")).alias("sources"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("event_ids")))).alias("event_ids"))
    if existing is None:
        return new
    old = existing.select(*keys, F.col("confidence").alias("__c"), F.col("match_type").alias("__m"), F.col("sources").alias("__s"), F.col("event_ids").alias("__e"), "calibrated_at")
    none = F.array().cast("array<string>")
    both = lambda a, b: F.array_sort(F.array_union(F.coalesce(a, none), F.coalesce(b, none)))
    j = new.join(old, keys, "full")
    frozen = F.col("calibrated_at").isNotNull()
    return j.select(*keys, F.when(frozen, F.col("__c")).otherwise(F.coalesce("confidence", "__c")).alias("confidence"), F.coalesce("match_type", "__m").alias("match_type"), both("sources", "__s").alias("sources"), both("event_ids", "__e").alias("event_ids"), "calibrated_at")


# Confidence of relations that are written one at a time, by source kind, type and target kind.
SINGLE_CONFIDENCE = {
    ("actor", "EMPLOYS_TECHNIQUE", "technique"): 0.7, ("malware", "ATTRIBUTED_TO", "actor"): 0.7,
    ("indicator", "INDICATES", "vulnerability"): 0.5, ("indicator", "INDICATES", "malware"): 0.6,
    ("indicator", "TARGETS", "sector"): 0.5, ("vulnerability", "AFFECTS", "sector"): 0.5,
}


def single_edges(claims: DataFrame, order: str) -> DataFrame:
    """Edges of claims (src_kind, type, trg_kind, src, trg, source, event_ids and ``order``) with the confidence of their kind. Claims of
    other kinds and with a blank end are dropped."""
    kinds = list(SINGLE_CONFIDENCE)
    kind = lambda s, t, g: F.concat_ws("/", s, t, g)
    numbers = F.create_map(*[F.lit(x) for n, k in enumerate(kinds) for x in ("/".join(k), n)])
    known = F.array(*[F.struct(F.lit(s).alias("src_kind"), F.lit(t).alias("type"), F.lit(g).alias("trg_kind"), F.lit(v).alias("confidence")) for (s, t, g), v in SINGLE_CONFIDENCE.items()])
    named = (F.trim("src") != "") & (F.trim("trg") != "")
    # Confidence and match type follow from the kind, so a claim is shuffled with its kind's number, its ends and what it adds to the lists alone.
    rows = claims.where(named).select(numbers[kind("src_kind", "type", "trg_kind")].alias("__k"), "src", "trg", "source", "event_ids").where(F.col("__k").isNotNull())
    out = rows.groupBy("__k", "src", "trg").agg(F.array_sort(F.collect_set("source")).alias("sources"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("event_ids")))).alias("event_ids"))
    out = out.withColumn("__k", F.get(known, F.col("__k")))
    return out.select(*[F.col("__k")[x].alias(x) for x in ("src_kind", "type", "trg_kind")], "src", "trg", F.col("__k")["confidence"].alias("confidence"), F.lit("single").alias("match_type"), "sources", "event_ids")


def fill_missing(nodes: DataFrame, told: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Nodes whose NULL columns take the earliest value told for their key; values that are there stay."""
    new = told.groupBy(key).agg(*[F.min(c).alias("__" + c) for c in columns])
    return nodes.join(new, key, "left").withColumns({c: F.coalesce(c, "__" + c) for c in columns}).drop(*["__" + c for c in columns])


def effective(changed: int, asked: int) -> int:
    """The number of rows a write changed; a write that was asked for rows and changed none is an error."""
    if asked > 0 and changed == 0:
        raise ValueError(f"a write of {asked} rows changed nothing")
    return changed


def first_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``; keys that are NULL are dropped. Aggregates whole rows, so no window sorts a hot key."""
    rest = [c for c in df.columns if c not in keys]
    row = F.min(F.struct(*order, *[c for c in rest if c not in order])).alias("__r")
    return df.dropna(subset=keys).groupBy(*keys).agg(row).select(*keys, *[F.col("__r")[c].alias(c) for c in rest])


def new_only(items: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Items in no stored key (left anti), each key once."""
    return items.dropDuplicates(keys).join(existing.select(*keys).distinct(), keys, "left_anti")


def secondary_labels(zones: Column) -> Column:
    return F.transform(F.filter(zones, lambda z: z != "global"), lambda z: F.initcap(z))


# The order in which labels are written.
LABEL_RANKS = ["Tactic", "Technique", "Malware", "ThreatActor", "Vulnerability", "Indicator"]


def label_rank(label: Column) -> Column:
    """The place of a label in the write order; all others come last."""
    known = F.create_map(*[F.lit(x) for k, v in enumerate(LABEL_RANKS) for x in (v, k)])
    return F.coalesce(known[label], F.lit(len(LABEL_RANKS)))


def accepted(claims: DataFrame, keys: list[str], source: str, known: list[str]) -> DataFrame:
    """Claims with ``refused``: ``unknown source`` for one that is not in ``known``, ``blank key``, or NULL for those that may be written."""
    named = F.forall(F.array(*[F.trim(F.coalesce(F.col(k).cast("string"), F.lit(""))) for k in keys]), lambda x: x != "")
    return claims.withColumn("refused", F.when(~F.coalesce(F.col(source).isin(known), F.lit(False)), "unknown source").when(~named, "blank key"))


# Natural keys of labels that are written one at a time, and the lists that accumulate over claims.
LABEL_KEYS = {
    "Vulnerability": ["cve_id"], "Indicator": ["indicator_type", "value"], "CVE": ["cve_id"], "Malware": ["name"], "ThreatActor": ["name"], "Technique": ["mitre_id"],
    "Tactic": ["mitre_id"], "Tool": ["mitre_id"],
}
ACCUMULATING = ["sources", "aliases", "malware_types", "uses_techniques", "tactic_phases"]


def merge_label(label: str, claims: DataFrame, order: str) -> DataFrame:
    """Nodes of one label out of claims, each column by its rule: the highest confidence, the first tag, the earliest import, folded zones, lists that
    accumulate, and the last value that is not NULL of everything else. Names of malware and actors, ids and CVE ids are made canonical first, so
    claims in other spellings are one node; blank keys and names that say nothing are left out."""
    keys = LABEL_KEYS[label]
    one = {"name": merge_name, "mitre_id": lambda x: F.upper(F.trim(x)), "cve_id": lambda x: F.upper(F.trim(x))}
    rows = claims.withColumns({k: one[k](F.col(k)) for k in keys if k in one})
    if label == "Indicator":
        rows = rows.withColumn("value", merge_value(F.col("indicator_type"), F.col("value")))
    if keys == ["name"]:
        rows = rows.where(~is_placeholder(F.col("name")))
    there = lambda names: [c for c in names if c in rows.columns]
    known = {*keys, order, "confidence", "tag", "first_imported_at", "zones", *ACCUMULATING}
    rest = [c for c in rows.columns if c not in known]
    return merge_nodes(rows, keys, order, highest=there(["confidence"]), earliest=there(["first_imported_at"]), first=there(["tag"]), last=rest, sets=there(ACCUMULATING), zones="zones" if "zones" in rows.columns else None)
