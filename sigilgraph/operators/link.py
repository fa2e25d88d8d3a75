"""Derived edges: exact-key, alias and co-occurrence joins, without OR conditions or cross joins."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ident import is_placeholder, merge_name


def or_join(left: DataFrame, right: DataFrame, pairs: list[tuple[Column, Column]], columns: list[Column]) -> DataFrame:
    """A column of the left and one of the right side, distinct, of rows that agree on any of several key pairs. A key may be an array, which is exploded.
    An OR in the condition would be a cross product instead.

    Keys that many rows of both sides have give far more pairs than rows, so no pair is shuffled to be made distinct: sources with the same set of
    keys are one group, the targets of a group are made distinct, and both are joined on the group, which gives each pair once. A group's sources
    are dealt over tasks, each of which gets the group's targets."""
    spark, (src, trg) = left.sparkSession, columns
    named = lambda df, side, c, out: reduce(DataFrame.unionByName, [df.select(c.alias(out), p[side].alias("__k")).where(F.col("__k").isNotNull()).withColumn("__i", F.lit(i)) for i, p in enumerate(pairs)])
    group = F.sort_array(F.collect_set(F.struct("__i", "__k"))).alias("__g")
    sources = named(left, 0, src, "src").groupBy("src").agg(group)
    groups = sources.select("__g").distinct().select("__g", F.explode("__g").alias("__p")).select("__g", "__p.*")
    targets = groups.join(named(right, 1, trg, "trg").distinct(), ["__i", "__k"]).select("__g", "trg").distinct()
    # A number that is told is kept: small tables that make very many pairs must not end in one task.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = sources.withColumn("__n", F.pmod(F.xxhash64("src"), F.lit(n))).repartition(n, "__g", "__n")
    held = targets.withColumn("__n", F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))).repartition(n, "__g", "__n")
    return dealt.join(held.hint("merge"), ["__g", "__n"]).select(F.col("src").alias(left.select(src).columns[0]), F.col("trg").alias(right.select(trg).columns[0]))


def names_of(names: Column, lists: bool = False) -> Column:
    """Usable join keys of names: canonical and no placeholder. An array gives one row for each."""
    if lists:
        return F.explode(F.filter(F.transform(names, merge_name), lambda x: ~is_placeholder(x)))
    return F.when(~is_placeholder(names), merge_name(names))


def overlap_join(left: DataFrame, right: DataFrame, left_list: str, right_list: str, columns: list[Column], most: int | None = None) -> DataFrame:
    """Pairs of rows whose lists share a member, with the number of shared members. Both lists are exploded and joined on the member;
    ``most`` uses only that many first members of the right list."""
    short = F.slice(right_list, 1, most) if most else F.col(right_list)
    a, b = left.withColumn("__m", F.explode(F.array_distinct(left_list))), right.withColumn("__m", F.explode(F.array_distinct(short)))
    return a.join(b, "__m").groupBy(*columns).agg(F.count("*").alias("shared"))


def shared_members(left: DataFrame, right: DataFrame, member: str) -> DataFrame:
    """(src, trg, shared): the number of members that rows (src, member) and (trg, member) have in common, all of them."""
    return left.distinct().join(right.distinct(), member).groupBy("src", "trg").agg(F.count("*").alias("shared"))


def build_links(steps: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """(step, ok, edges) of all steps in order. Each is planned on its own: one that cannot be planned is reported with ok = false and no
    count, and the others go on."""
    parts = []
    for name, step in steps.items():
        try:
            edges, ok = step().agg(F.count("*").alias("edges")), True
        except AnalysisException:
            edges, ok = None, False
        spark = SparkSession.active()
        edges = spark.range(1).select(F.lit(None).cast("long").alias("edges")) if edges is None else edges
        parts.append(edges.select(F.lit(name).alias("step"), F.lit(ok).alias("ok"), "edges"))
    return reduce(DataFrame.unionByName, parts)


def link_exact(src: DataFrame, src_key: Column, src_id: str, trg: DataFrame, trg_key: Column, trg_id: str, kind: str, confidence: float, match_type: str) -> DataFrame:
    """Edges between rows with equal keys; a list key is exploded by the caller's expression."""
    a = src.select(F.col(src_id).alias("src"), src_key.alias("__k")).where(F.col("__k").isNotNull())
    b = trg.select(F.col(trg_id).alias("trg"), trg_key.alias("__k")).where(F.col("__k").isNotNull())
    out = a.join(b, "__k").select("src", "trg").distinct()
    return out.select(F.lit(kind).alias("type"), "src", "trg", F.lit(confidence).cast("double").alias("confidence"), F.lit(match_type).alias("match_type"))


def orphans(src: DataFrame, src_key: Column, trg: DataFrame, trg_key: Column) -> DataFrame:
    """Rows whose key has no target (left anti)."""
    keys = trg.select(trg_key.alias("__k")).where(F.col("__k").isNotNull()).distinct()
    return src.withColumn("__k", src_key).where(F.col("__k").isNotNull()).join(keys, "__k", "left_anti").drop("__k")


def capped(items: DataFrame, group: list[str], order: list[str], cap: Column | int) -> DataFrame:
    """The first ``cap`` rows of each group; the cap may be a column."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return items.withColumn("__n", rank).where(F.col("__n") <= cap).drop("__n")


def event_caps(counts: DataFrame, caps: dict[str, int], most: int = 50_000, floors: dict[str, int] | None = None) -> DataFrame:
    """Per event and kind: the cap after scaling. ``counts``: event_id, kind, n. Where the kinds' products exceed ``most`` pairs, each cap shrinks
    by the square root of the excess, not below its floor."""
    floors = floors or {}
    cap = F.create_map(*[F.lit(x) for kv in caps.items() for x in kv])
    floor = F.create_map(*[F.lit(x) for k in caps for x in (k, floors.get(k, 50))])
    base = counts.withColumn("cap", F.least("n", cap[F.col("kind")]))
    n = lambda k: F.coalesce(F.max(F.when(F.col("kind") == k, F.col("cap"))), F.lit(0)).cast("double")
    total = base.groupBy("event_id").agg((n("actor") * n("technique") + n("malware") * n("actor") + n("indicator") * n("malware") + n("indicator") * n("vulnerability")).alias("pairs"))
    scale = F.when(F.col("pairs") > most, F.sqrt(F.lit(float(most)) / F.col("pairs"))).otherwise(F.lit(1.0))
    return base.join(total, "event_id").select("event_id", "kind", F.least("cap", F.greatest(F.floor(F.col("cap") * scale), floor[F.col("kind")])).cast("int").alias("cap"))


def event_relations(items: DataFrame | dict[str, DataFrame], rules: list[tuple[str, str, str]], confidence: float = 0.5) -> DataFrame:
    """Relations between items of one event: for each (type, source kind, target kind) an equi-join on event_id of items (event_id, kind, key), or of
    a table (event_id, key) for each kind, whose keys keep their own types until they are written as text.

    An item counts once an event, so each row of a pair is another event: pairs are counted by their keys, and shuffled without events and types.
    Only a type that several rules make has events to tell apart."""
    of = lambda kind: items[kind] if isinstance(items, dict) else items.where(F.col("kind") == kind)
    made: dict[str, list[DataFrame]] = {}
    for kind, a, b in rules:
        left, right = of(a).select("event_id", F.col("key").alias("src")).distinct(), of(b).select("event_id", F.col("key").alias("trg")).distinct()
        made.setdefault(kind, []).append(left.join(right, "event_id"))
    text = [F.col(c).cast("string").alias(c) for c in ("src", "trg")]
    parts = []
    for kind, pairs in made.items():
        if len(pairs) == 1:
            counted = pairs[0].groupBy("src", "trg").agg(F.count("*").alias("events"))
        else:
            counted = reduce(DataFrame.unionByName, [p.select("event_id", *text) for p in pairs]).groupBy("src", "trg").agg(F.countDistinct("event_id").alias("events"))
        parts.append(counted.select(F.lit(kind).alias("type"), *text, "events"))
    return reduce(DataFrame.unionByName, parts).withColumn("confidence", F.lit(confidence).cast("double"))


def link_topology(edges: DataFrame, src: DataFrame, src_key: str, trg: DataFrame, trg_key: str, kind: str) -> DataFrame:
    """Edges (src, trg) both of whose ends exist, once each: the one form of all topology writers."""
    a, b = src.select(F.col(src_key).alias("src")).distinct(), trg.select(F.col(trg_key).alias("trg")).distinct()
    return edges.select("src", "trg").dropna().distinct().join(a, "src", "left_semi").join(b, "trg", "left_semi").withColumn("type", F.lit(kind))


def contains_join(needles: DataFrame, texts: DataFrame, gram: int = 6) -> DataFrame:
    """(needle, text_id), distinct, of all needles (needle, part) and texts (text_id, text) whose text contains the part, by exact case.

    A text that contains a part has all of the part's grams of ``gram`` characters, so each part is looked up by the one of its grams that the
    fewest texts have, and held against these texts alone. Parts shorter than a gram are a gram of their own length. A part with a gram
    that no text has fits none; empty and NULL parts fit nothing.

    Equal parts and equal texts make far more pairs than rows, so each is looked up once: needles with the same set of parts are a group, and so are
    texts' ids. Groups that fit are made distinct, and give each pair once without a shuffle of pairs."""
    told = lambda df, key, text: df.where(F.length(text) > 0).groupBy(key).agg(F.sort_array(F.collect_set(text)).alias("__s"))
    asked, held = told(needles, "needle", "part"), told(texts, "text_id", "text")
    groups = lambda df, text: df.select("__s").distinct().select(F.col("__s").alias(f"__{text}s"), F.explode("__s").alias(text))
    fits = _containing(asked.select(F.explode("__s").alias("part")).distinct(), held.select(F.explode("__s").alias("text")).distinct(), gram)
    met = groups(asked, "part").join(fits, "part").join(groups(held, "text"), "text").select("__parts", "__texts").distinct()
    named = asked.select("needle", F.col("__s").alias("__parts")).join(met, "__parts").select("needle", "__texts")
    return named.join(held.select("text_id", F.col("__s").alias("__texts")).hint("merge"), "__texts").select("needle", "text_id")


def _containing(parts: DataFrame, texts: DataFrame, gram: int) -> DataFrame:
    """(part, text), distinct, of distinct parts (part) and distinct texts (text) that hold them."""
    cut = lambda c, n: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(c, i, n)))
    parts = parts.withColumn("__l", F.least(F.length("part"), F.lit(gram)))
    sizes = F.broadcast(parts.groupBy("__l").agg(F.lit(1).alias("__x")).drop("__x"))  # at most ``gram`` rows
    index = texts.join(sizes, F.length("text") >= F.col("__l")).select("text", F.explode(cut(F.col("text"), F.col("__l"))).alias("__g"))
    counts = index.groupBy("__g").agg(F.count("*").alias("__n"))
    asked = parts.select("part", F.explode(cut(F.col("part"), F.col("__l"))).alias("__g")).join(counts, "__g", "left")
    best = asked.groupBy("part").agg(F.count_if(F.col("__n").isNull()).alias("__miss"), F.min(F.struct("__n", "__g")).alias("__b")).where("__miss = 0")
    return best.select("part", F.col("__b.__g").alias("__g")).join(index, "__g").where(F.contains("text", F.col("part"))).select("part", "text")


def event_cooccurrence(indicator_events: DataFrame, malware_events: DataFrame, most: int = 200) -> DataFrame:
    """(indicator, malware), distinct, that share one of the indicator's first ``most`` events. indicator_events: indicator, event_id, at; malware_events:
    malware, event_id; events without an id count for nothing. An indicator's events are cut before they meet any malware."""
    events = indicator_events.where("event_id <> ''").groupBy("indicator", "event_id").agg(F.min("at").alias("at"))
    first = capped(events, ["indicator"], ["at", "event_id"], most).select("indicator", "event_id")
    return first.join(malware_events.select("malware", "event_id").distinct(), "event_id").select("indicator", "malware").distinct()
