"""Relation definitions to edges: what attributes say about each other, and one job that resolves all kinds of it against the nodes.

A definition names both of its ends by type and key fields. Its route tells which field counts and which labels the end may be. Ends are
resolved by an index of the nodes with a row for each name that a node goes by. Equal pairs of ends are folded before they are joined
with the index, so a pair that many attributes repeat is looked up once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tags as G
from ..functions.ident import is_placeholder, merge_name, merge_value
from ..functions.scalars import ATTRIBUTE_TYPES, accepted_value, lookup
from ..session import materialize

DEFINITION = "rel_type string, from_type string, from_key map<string,string>, to_type string, to_key map<string,string>, confidence double, source string, event_id string, seq long"

# Group, relation type, type that the definition must name as source (None: any) and as target, key fields, labels of the ends.
ROUTES = [
    ("EMPLOYS_TECHNIQUE_actor", "EMPLOYS_TECHNIQUE", "ThreatActor", None, "name", "mitre_id", "ThreatActor", "Technique"),
    ("EMPLOYS_TECHNIQUE_campaign", "EMPLOYS_TECHNIQUE", "Campaign", None, "name", "mitre_id", "Campaign", "Technique"),
    ("IMPLEMENTS_TECHNIQUE_malware", "IMPLEMENTS_TECHNIQUE", "Malware", None, "name", "mitre_id", "Malware", "Technique"),
    ("IMPLEMENTS_TECHNIQUE_tool", "IMPLEMENTS_TECHNIQUE", "Tool", None, "mitre_id", "mitre_id", "Tool", "Technique"),
    ("ATTRIBUTED_TO", "ATTRIBUTED_TO", None, None, "name", "name", "Malware", "ThreatActor"),
    ("INDICATES_malware", "INDICATES", None, "Malware", "value", "name", "Indicator", "Malware"),
    ("TARGETS_indicator", "TARGETS", "Indicator", None, "value", "name", "Indicator", "Sector"),
    ("AFFECTS_vulnerability", "AFFECTS", None, None, "cve_id", "name", "Vulnerability", "Sector"),
    ("AFFECTS_cve", "AFFECTS", None, None, "cve_id", "name", "CVE", "Sector"),
    ("EXPLOITS_vulnerability", "EXPLOITS", None, None, "value", "cve_id", "Indicator", "Vulnerability"),
    ("EXPLOITS_cve", "EXPLOITS", None, None, "value", "cve_id", "Indicator", "CVE"),
]
MATCH_TYPES = {"EXPLOITS": "cve_tag"}
#: Labels whose nodes a definition makes if they are missing.
MADE = "Sector"


def embedded(attrs: DataFrame) -> DataFrame:
    """Definitions (DEFINITION) that staging attributes (event_id, idx, attr_type, value, tags) carry in their tags: an indicator's malware, sector
    and exploited CVEs (confidence 0.7 at least), a malware's actor, an actor's techniques, a vulnerability's and a tool's sector. Blank
    and oversized values, and tags that name nothing, give none."""
    c = F.col
    value, kind = F.trim("value"), c("attr_type")
    text = F.when(kind == "text", F.when(value.rlike(r"^T\d{4}"), "technique").when(value.rlike(r"^TA\d{4}"), "tactic").when(value.rlike(r"^S\d{4}"), "tool"))
    kind = F.coalesce(lookup({"vulnerability": "vulnerability", "threat-actor": "actor", "malware-type": "malware"}, kind), text, F.lit("indicator"))
    told = {"__kind": kind, "__value": value, "__confidence": G.confidence_of(c("tags")), "__sector": G.sector_of(c("tags")), "__source": G.source_of(c("tags"))}
    value, confidence, sector = c("__value"), c("__confidence"), c("__sector")  # columns, so that an attribute's definitions share them
    key = lambda **fields: F.map_from_arrays(F.array(*[F.lit(k) for k in fields]), F.array(*[v.cast("string") for v in fields.values()]))

    def one(rel, src, src_key, trg, trg_key, conf=confidence):
        return F.struct(F.lit(rel).alias("rel_type"), F.lit(src).alias("from_type"), src_key.alias("from_key"), F.lit(trg).alias("to_type"), trg_key.alias("to_key"), conf.cast("double").alias("confidence"))

    said = lambda told: F.filter(told, lambda x: F.coalesce(x != "", F.lit(False)))
    to_sector = lambda rel, src, src_key: F.transform(said(F.array(sector)), lambda s: one(rel, src, src_key, "Sector", key(name=s)))
    indicator = key(value=value, indicator_type=lookup(ATTRIBUTE_TYPES, c("attr_type"), "unknown"))
    of_indicator = F.concat(
        F.transform(said(G.malware_of(c("tags"))), lambda m: one("INDICATES", "Indicator", indicator, "Malware", key(name=m))),
        to_sector("TARGETS", "Indicator", indicator),
        F.transform(said(G.exploits_of(c("tags"))), lambda v: one("EXPLOITS", "Indicator", indicator, "Vulnerability", key(cve_id=v), F.greatest(confidence, F.lit(0.7)))),
    )
    parts = {
        "vulnerability": to_sector("AFFECTS", "Vulnerability", key(cve_id=F.upper(value))),
        "actor": F.transform(said(G.techniques_of(c("tags"))), lambda x: one("EMPLOYS_TECHNIQUE", "ThreatActor", key(name=value), "Technique", key(mitre_id=x))),
        "malware": F.transform(said(F.array(G.actor_of(c("tags")))), lambda a: one("ATTRIBUTED_TO", "Malware", key(name=value), "ThreatActor", key(name=a))),
        "tool": to_sector("TARGETS", "Tool", key(mitre_id=F.substring_index(value, ": ", 1))),
        "indicator": of_indicator,
    }
    chosen = reduce(lambda a, kv: a.when(c("__kind") == kv[0], kv[1]), list(parts.items())[1:], F.when(c("__kind") == "vulnerability", parts["vulnerability"]))
    rows = attrs.where(accepted_value(c("value"))).withColumns(told)
    return rows.select(F.explode(chosen).alias("d"), c("__source").alias("source"), c("event_id").cast("string").alias("event_id"), (c("event_id").cast("long") * 1000 + c("idx")).alias("seq")).select("d.*", "source", "event_id", "seq")


def canonical(label: Column, kind: Column, key: Column) -> Column:
    """An end's key as nodes store it; NULL if it is blank."""
    name = F.when(label == "Indicator", merge_value(kind, key)).when(label.isin("Malware", "ThreatActor", "Campaign", "Sector"), merge_name(key)).otherwise(F.upper(F.trim(key)))
    return F.nullif(name, F.lit(""))


def endpoint_index(nodes: DataFrame) -> DataFrame:
    """(label, key, id), distinct, of nodes (label, id, kind, key, aliases): the canonical key and all aliases of a node lead to it. ``kind`` is
    an indicator's type; names that are placeholders lead nowhere."""
    names = F.concat(F.array(F.col("key")), F.coalesce("aliases", F.array().cast("array<string>")))
    rows = nodes.select("label", "id", "kind", F.explode(names).alias("name"))
    rows = rows.where(~F.col("label").isin("Malware", "ThreatActor", "Campaign") | ~is_placeholder(F.col("name")))
    return rows.select("label", canonical(F.col("label"), F.col("kind"), F.col("name")).alias("key"), "id").dropna().distinct()


def routed(definitions: DataFrame) -> DataFrame:
    """Definitions with a row for each group that their route has, and the canonical keys of both ends; ``dropped`` tells why one goes
    nowhere: ``no route`` (its types fit no group) or ``blank end``."""
    names = ["grp", "type", "frm", "trg_type", "src_field", "trg_field", "src_label", "trg_label"]
    route = lambda r: F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(names, r)])
    table = lookup({t: F.array(*[route(r) for r in ROUTES if r[1] == t]) for t in dict.fromkeys(r[1] for r in ROUTES)}, F.col("rel_type"))
    fits = lambda want, got: want.isNull() | F.coalesce(want == got, F.lit(False))
    found = F.filter(table, lambda r: fits(r["frm"], F.col("from_type")) & fits(r["trg_type"], F.col("to_type")))
    rows = definitions.select("*", F.explode_outer(found).alias("r"))
    src = canonical(F.col("r.src_label"), F.col("from_key")["indicator_type"], F.col("from_key")[F.col("r.src_field")])
    trg = canonical(F.col("r.trg_label"), F.col("to_key")["indicator_type"], F.col("to_key")[F.col("r.trg_field")])
    rows = rows.select("rel_type", "r.grp", "r.type", "r.src_label", src.alias("src_key"), "r.trg_label", trg.alias("trg_key"), F.coalesce("confidence", F.lit(0.5)).alias("confidence"), "source", "event_id", "seq")
    return rows.withColumn("dropped", F.when(F.col("grp").isNull(), "no route").when(F.col("src_key").isNull() | F.col("trg_key").isNull(), "blank end"))


class Dispatch:
    """Definitions (DEFINITION) resolved against an index (label, key, id), as tables:

    ``edges``    (type, src_label, src, trg_label, trg, confidence, match_type, sources): each edge once, with the confidence of the last
                 definition by seq (ties: the highest) and the distinct sources.
    ``members``  (type, src, trg, event_id), distinct: the events of an edge, which a list could not hold.
    ``sectors``  (id): nodes that definitions make.
    ``report``   (grp, definitions, dropped, unresolved, edges, most): definitions with a blank end, with an end that no node goes by, edges
                 made, and the most edges of one pair of names. Definitions without a route are counted under their type.

    An end that several nodes go by gives an edge for each. Null confidence counts as 0.5; a null source or event is no member."""

    KEYS = ["grp", "type", "src_label", "src_key", "trg_label", "trg_key"]

    def __init__(self, definitions: DataFrame, index: DataFrame):
        self.rows = materialize(routed(definitions), "definitions")
        told = F.max(F.struct("seq", "confidence")).alias("told")
        pairs = self.rows.where("dropped IS NULL").groupBy(*self.KEYS).agg(told, F.collect_set("source").alias("sources"), F.count("*").alias("n"))
        pairs = materialize(pairs, "pairs")
        made = pairs.where(F.col("trg_label") == MADE).select(F.col("trg_label").alias("label"), F.col("trg_key").alias("key"), F.concat(F.lit(f"{MADE}:"), "trg_key").alias("id"))
        index = index.where(F.col("label") != MADE).unionByName(made.distinct())
        end = lambda p: index.select(F.col("label").alias(f"{p}_label"), F.col("key").alias(f"{p}_key"), F.col("id").alias(p))
        self.found = materialize(pairs.join(end("src"), ["src_label", "src_key"], "left").join(end("trg"), ["trg_label", "trg_key"], "left"), "resolved")
        self.known = self.found.where("src IS NOT NULL AND trg IS NOT NULL")

    @property
    def edges(self) -> DataFrame:
        e = self.known.groupBy("type", "src_label", "src", "trg_label", "trg").agg(F.max("told").alias("told"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("sources")))).alias("sources"))
        match = lookup(MATCH_TYPES, F.col("type"), "tag")
        return e.select("type", "src_label", "src", "trg_label", "trg", F.col("told.confidence").alias("confidence"), match.alias("match_type"), "sources")

    @property
    def members(self) -> DataFrame:
        events = self.rows.where("dropped IS NULL AND event_id <> ''").select(*self.KEYS, "event_id")
        return events.join(self.known.select(*self.KEYS, "src", "trg"), self.KEYS).select("type", "src", "trg", "event_id").distinct()

    @property
    def sectors(self) -> DataFrame:
        return self.known.where(F.col("trg_label") == MADE).select(F.col("trg").alias("id")).distinct()

    @property
    def report(self) -> DataFrame:
        grp = F.coalesce("grp", F.concat(F.lit("no route: "), F.coalesce("rel_type", F.lit(""))))
        asked = self.rows.groupBy(grp.alias("grp")).agg(F.count("*").alias("definitions"), F.count("dropped").alias("dropped"))
        per = self.found.groupBy(*self.KEYS).agg(F.max("n").alias("n"), F.count_if(F.col("src").isNotNull() & F.col("trg").isNotNull()).alias("made"))
        per = per.groupBy("grp").agg(F.sum(F.when(F.col("made") == 0, F.col("n")).otherwise(0)).alias("unresolved"), F.max("made").alias("most"))
        edges = self.known.select("grp", "src", "trg").distinct().groupBy("grp").agg(F.count("*").alias("edges"))
        out = asked.join(per, "grp", "left").join(edges, "grp", "left")  # a row for each group
        return out.select("grp", "definitions", "dropped", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("unresolved", "edges", "most")])
