"""STIX 2.1 bundles of graph nodes with their neighbourhood, and of staging events.

A bundle is never a row: its objects are rows (seed, id, object), which are sorted and written as text line by line, so a technique with
millions of neighbours is spread over as many files as it takes. Its id is a hash over its sorted ids, which a task reads as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tags as G
from ..functions.ident import STIX_TYPES, is_placeholder, merge_name, natural_key, uuid5
from ..functions.scalars import stix_time, zone_fold
from ..session import materialize

#: Columns that nodes may have beside label, key and managed; a missing one is NULL.
PROPERTIES = {
    "name": "string", "aliases": "array<string>", "description": "string", "indicator_type": "string", "value": "string", "indicator_classification": "array<string>",
    "malware_types": "array<string>", "is_family": "boolean", "mitre_id": "string", "tactic_phases": "array<string>", "shortname": "string", "tool_types": "array<string>", "cve_id": "string",
    "cvss_score": "double", "severity": "string", "attack_vector": "string", "published": "string", "last_modified": "string", "cisa_exploit_add": "string", "cisa_action_due": "string",
    "cisa_required_action": "string", "cisa_vulnerability_name": "string", "cwe": "array<string>", "cisa_cwes": "array<string>", "ref_tags": "array<string>", "reference_urls": "array<string>",
    "affected_products": "array<string>", "zones": "array<string>", "event_ids": "array<string>", "attribute_ids": "array<string>", "first_imported_at": "timestamp", "last_updated": "timestamp", "first_seen": "timestamp", "last_seen": "timestamp",
}
# Fields that a vulnerability's object keeps, and where references lead to.
PROMOTED = ["cvss_score", "severity", "attack_vector", "published", "last_modified", "cisa_exploit_add", "cisa_action_due", "cisa_required_action", "cisa_vulnerability_name", "cwe", "cisa_cwes", "ref_tags", "reference_urls", "affected_products"]
ATTACK_URL, CVE_URL = "https://attack.mitre.org/", "https://nvd.nist.gov/vuln/detail/"
# What a seed's bundle holds: label of the seed, depth from which, edge type, whether the seed is its source, labels at the other
# end, the relation's type, and whether the relation runs from the edge's source to its target.
NEIGHBOURS = [
    ("Indicator", 1, "INDICATES", True, ["Malware"], "indicates", True),
    ("Indicator", 2, "EXPLOITS", True, ["CVE", "Vulnerability"], "indicates", True),
    ("Indicator", 2, "USES_TECHNIQUE", True, ["Technique"], "indicates", True),
    ("Indicator", 2, "TARGETS", True, ["Sector"], "targets", True),
    ("ThreatActor", 1, "ATTRIBUTED_TO", False, ["Malware"], "attributed-to", True),
    ("ThreatActor", 2, "EMPLOYS_TECHNIQUE", True, ["Technique"], "uses", True),
    ("ThreatActor", 2, "RUNS", True, ["Campaign"], "attributed-to", False),
    ("Technique", 1, "EMPLOYS_TECHNIQUE", False, ["ThreatActor"], "uses", True),
    ("Technique", 2, "IMPLEMENTS_TECHNIQUE", False, ["Malware", "Tool"], "uses", True),
    ("Technique", 2, "USES_TECHNIQUE", False, ["Indicator"], "indicates", True),
    ("Vulnerability", 1, "EXPLOITS", False, ["Indicator"], "indicates", True),
    ("Vulnerability", 2, "AFFECTS", True, ["Sector"], "targets", True),
]
#: Labels whose objects have a builder.
IDENTIFIED = ["Indicator", "Technique", "Tactic", "CVE", "Vulnerability", "Malware", "ThreatActor", "Tool", "Campaign", "Sector"]
EXPORT_TYPES = {"indicator": "Indicator", "actor": "ThreatActor", "technique": "Technique", "cve": "Vulnerability"}


def held_kinds(label: str) -> tuple[list[str], list[str]]:
    """Labels of nodes and types of edges that a rule may put into bundles of ``label``, the seeds' own labels among them."""
    rules = [r for r in NEIGHBOURS if r[0] == label]
    labels = {label, *(["CVE"] if label == "Vulnerability" else []), *(o for r in rules for o in r[4])}
    types = {r[2] for r in rules} | ({"IMPLEMENTS_TECHNIQUE"} if label == "ThreatActor" else set())  # what an actor's malware uses
    return sorted(labels), sorted(types)


def relationship_id(kind: Column, src: Column, trg: Column) -> Column:
    return F.concat(F.lit("relationship--"), uuid5(F.lower(F.concat(F.lit("relationship:"), F.concat_ws("|", src, kind, trg)))))


def relationship(kind: Column, src: Column, trg: Column, now: Column) -> Column:
    at = stix_time(now)
    return F.to_json(F.struct(F.lit("relationship").alias("type"), F.lit("2.1").alias("spec_version"), relationship_id(kind, src, trg).alias("id"), at.alias("created"), at.alias("modified"), kind.alias("relationship_type"), src.alias("source_ref"), trg.alias("target_ref")))


def with_source_times(nodes: DataFrame, claims: DataFrame) -> DataFrame:
    """Nodes with first_at_source and last_at_source over the claims (label, key, first, last) of all their sources, by one grouped join. A
    campaign has its own first_seen and last_seen instead; sources and sectors have none."""
    seen = claims.groupBy("label", "key").agg(F.min("first").alias("__first"), F.max("last").alias("__last"))
    own, none = F.col("label") == "Campaign", F.col("label").isin("Source", "Sector")
    pick = lambda told, mine: F.when(own, F.col(mine)).when(~none, F.col(told))
    return nodes.join(seen, ["label", "key"], "left").withColumns({"first_at_source": pick("__first", "first_seen"), "last_at_source": pick("__last", "last_seen")}).drop("__first", "__last")


def _filled(nodes: DataFrame) -> DataFrame:
    return nodes.withColumns({c: F.lit(None).cast(kind) for c, kind in PROPERTIES.items() if c not in nodes.columns})


def _listed(c: Column) -> Column:
    """Members that are there; NULL for none."""
    kept = F.array_compact(c)
    return F.when(F.size(kept) > 0, kept)


def _said(c: Column) -> Column:
    return F.when(c != "", c)


def attribute_pattern(kind: Column, value: Column) -> Column:
    """Pattern of an attribute type's value; NULL for types without one."""
    safe = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    path = F.when(kind.isin("ip-dst", "ip-src", "ipv4"), "ipv4-addr:value").when(kind == "ipv6", "ipv6-addr:value").when(kind.isin("domain", "hostname"), "domain-name:value").when(kind == "url", "url:value")
    path = path.when(kind.isin("md5", "sha1", "sha256", "sha512"), F.concat(F.lit("file:hashes.'"), F.upper(kind), F.lit("'"))).when(kind == "email-src", "email-addr:value")
    return F.concat(F.lit("["), path, F.lit(" = '"), safe, F.lit("']"))


def identified(nodes: DataFrame) -> DataFrame:
    """Nodes with their object's id. The fields that a label's id is drawn from are picked first, so that a row has two texts at most to bring to
    a normal form, whatever its label."""
    c, label = F.col, F.col("label")
    rows = _filled(nodes)
    mitre = F.coalesce(_said(c("mitre_id")), c("name"))
    first = F.when(label == "Indicator", c("indicator_type")).when(label.isin("Technique", "Tactic"), mitre).when(label.isin("CVE", "Vulnerability"), c("cve_id")).otherwise(c("name"))
    kinds = F.create_map(*[F.lit(x) for k in IDENTIFIED for x in (k, STIX_TYPES[k])])
    kind, second = kinds[label], F.when(label == "Indicator", c("value"))
    known = F.concat(kind, F.lit("--"), uuid5(F.when(label == "Indicator", natural_key([first, second], kind)).otherwise(natural_key([first], kind))))
    return rows.withColumn("id", F.when(label.isin(*IDENTIFIED), known).otherwise(F.concat(F.lit("x-kg-unknown--"), uuid5(F.concat_ws(":", F.lit("x-kg-unknown"), "label", "key")))))


def objects(nodes: DataFrame, now: Column) -> DataFrame:
    """(label, key, id, object) of nodes (label, key, PROPERTIES, first_at_source, last_at_source): each label's own fields, the times of its
    sources and its stay here, its zones and where it was staged. Fields without a value are left out; a time that is missing is ``now``.
    A label without a builder gives an object of an unknown type."""
    c, label = F.col, F.col("label")
    rows = nodes if "id" in nodes.columns else identified(nodes)
    iso = lambda x: F.date_format(x, "yyyy-MM-dd'T'HH:mm:ssxxx")
    made, changed = stix_time(F.coalesce("first_imported_at", now)), stix_time(F.coalesce("last_updated", now))
    blank = lambda x: F.coalesce(x, F.lit(""))
    reference = lambda source, ident, url: F.when(ident != "", F.array(F.struct(F.lit(source).alias("source_name"), ident.alias("external_id"), url.alias("url"))))
    technique_url = F.concat(F.lit(ATTACK_URL + "techniques/"), F.replace(c("mitre_id"), F.lit("."), F.lit("/")))
    phases = F.transform(F.filter(c("tactic_phases"), lambda p: F.coalesce(p != "", F.lit(False))), lambda p: F.struct(F.lit("mitre-attack").alias("kill_chain_name"), F.lower(p).alias("phase_name")))
    types = F.coalesce(_listed(c("malware_types")), F.array(F.lit("unknown")))
    family = F.exists(types, lambda x: F.contains(F.lower(x), F.lit("family"))) | F.coalesce("is_family", F.lit(False))
    valid, inferred = stix_time(F.coalesce("first_at_source", "first_imported_at", now)), F.when(c("first_at_source").isNull(), F.lit(True))
    shared = lambda n: F.array_distinct(F.filter(n, lambda x: F.coalesce(x != "", F.lit(False))))
    extra = [
        iso(c("first_at_source")).alias("x_kg_first_seen_at_source"), iso(c("last_at_source")).alias("x_kg_last_seen_at_source"), iso(c("first_imported_at")).alias("x_kg_first_imported_at"), iso(c("last_updated")).alias("x_kg_last_updated"),
    ]
    tail = [_listed(F.filter(c("zones"), lambda z: z.isin(G.ZONES))).alias("x_kg_zones"), _listed(shared(c("event_ids"))).alias("x_kg_event_ids"), _listed(shared(c("attribute_ids"))).alias("x_kg_attribute_ids")]

    def sdo(kind: str, *fields: Column, times: bool = True) -> Column:
        head = [F.lit(kind).alias("type"), F.lit("2.1").alias("spec_version"), c("id"), made.alias("created"), changed.alias("modified")]
        return F.to_json(F.struct(*head, *fields, *(extra if times else []), *tail))

    text, also = c("description"), _listed(c("aliases")).alias("aliases")
    cve = blank(c("cve_id"))
    promoted = [(_listed(c(f)) if PROPERTIES[f].startswith("array") else _said(c(f)) if PROPERTIES[f] == "string" else c(f)).alias("x_kg_" + f) for f in PROMOTED]
    vulnerability = sdo("vulnerability", cve.alias("name"), text, reference("cve", cve, F.concat(F.lit(CVE_URL), cve)).alias("external_references"), *promoted)
    builders = {
        "Indicator": sdo("indicator", F.coalesce(_said(c("name")), F.concat(blank(c("indicator_type")), F.lit(":"), blank(c("value")))).alias("name"), F.coalesce(_listed(c("indicator_classification")), F.array(F.lit("malicious-activity"))).alias("indicator_types"),
                         F.coalesce(attribute_pattern(c("indicator_type"), c("value")), F.concat(F.lit("[artifact:payload_bin = '"), F.replace(F.replace(blank(c("value")), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("']"))).alias("pattern"),
                         F.lit("stix").alias("pattern_type"), F.lit("2.1").alias("pattern_version"), valid.alias("valid_from"), inferred.alias("x_kg_first_seen_inferred")),
        "Malware": sdo("malware", blank(c("name")).alias("name"), text, types.alias("malware_types"), family.alias("is_family"), also),
        "ThreatActor": sdo("intrusion-set", blank(c("name")).alias("name"), text, also),
        "Technique": sdo("attack-pattern", F.coalesce("name", blank(c("mitre_id"))).alias("name"), text, _listed(phases).alias("kill_chain_phases"), reference("mitre-attack", c("mitre_id"), technique_url).alias("external_references")),
        "Tool": sdo("tool", blank(c("name")).alias("name"), text, F.coalesce(_listed(c("tool_types")), F.array(F.lit("unknown"))).alias("tool_types"), also),
        "Tactic": sdo("x-mitre-tactic", F.coalesce("name", blank(c("mitre_id"))).alias("name"), text, _said(c("shortname")).alias("x_mitre_shortname"), reference("mitre-attack", c("mitre_id"), F.concat(F.lit(ATTACK_URL + "tactics/"), "mitre_id")).alias("external_references")),
        "Campaign": sdo("campaign", blank(c("name")).alias("name"), text, also),
        "CVE": vulnerability, "Vulnerability": vulnerability,
        "Sector": sdo("identity", blank(c("name")).alias("name"), F.lit("class").alias("identity_class"), F.array(blank(c("name"))).alias("sectors"), times=False),
    }
    built = reduce(lambda a, kv: a.when(label == kv[0], kv[1]), builders.items(), F.when(F.lit(False), F.lit("")))
    unknown = F.to_json(F.struct(F.lit("x-kg-unknown").alias("type"), c("id"), F.lit("2.1").alias("spec_version")))
    return rows.select("label", "key", "id", built.otherwise(unknown).alias("object"))


def seeds(nodes: DataFrame, label: str, asked: DataFrame | None = None) -> DataFrame:
    """(seed, label, key): what is exported for each asked text (column asked), or for all nodes of ``label`` by their own name. An indicator is asked
    for by its value, an actor by its name or an alias, a vulnerability by its CVE id. Of several nodes that an asked text fits the
    least key is taken, and a Vulnerability before a CVE. Nodes that are not managed are no seeds; what fits nothing has no row."""
    rows = _filled(nodes).where("managed")
    named = {"Indicator": F.array("value"), "ThreatActor": F.filter(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))), lambda x: ~is_placeholder(x)), "Technique": F.array("mitre_id"), "Vulnerability": F.array("cve_id")}
    rows = rows.where(F.col("label").isin(["CVE", "Vulnerability"] if label == "Vulnerability" else [label]))
    fold = merge_name if label == "ThreatActor" else (lambda x: x)
    names = named[label] if asked is not None else F.array(F.element_at(named[label], 1))
    own = rows.select("label", "key", F.explode(names).alias("seed")).where(F.col("seed").isNotNull()).withColumn("__k", fold(F.col("seed")))
    if asked is not None:
        own = own.drop("seed").join(asked.select(F.col("asked").alias("seed"), fold(F.col("asked")).alias("__k")).distinct(), "__k")
    best = F.min(F.struct((F.col("label") == "CVE").alias("late"), "key", "label")).alias("b")
    return own.groupBy("seed").agg(best).select("seed", "b.label", "b.key")


def members(known: DataFrame, edges: DataFrame, found: DataFrame, label: str) -> DataFrame:
    """(seed, label, key, id, kind, src_id, trg_id, depth): what the bundle of each seed (``seeds``) holds: nodes by label, key and id, and relations by kind
    and the ids of both ends, each with the depth from which a bundle holds it; a row may come more than once. ``known``: label, key and id
    of managed nodes, as only these take part. All rules go over the edges in one pass. Nodes are joined by merging, as there are far too many
    for the driver to send them to all executors."""
    own = ["CVE", "Vulnerability"] if label == "Vulnerability" else [label]
    names = ["depth", "type", "forward", "other", "rel", "straight"]
    wanted = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, (d, e, f, o, r, s))]) for k, d, e, f, others, r, s in NEIGHBOURS if k == label for o in others])
    known = known.hint("merge")

    def near(start: DataFrame, rules: Column, own: list[str]) -> DataFrame:
        """Relations of (seed, label, key, id) with the far node as label, key and id."""
        fits = lambda r: (r["type"] == F.col("type")) & F.when(r["forward"], F.col("src_label").isin(own) & (F.col("trg_label") == r["other"])).otherwise(F.col("trg_label").isin(own) & (F.col("src_label") == r["other"]))
        e = edges.select("type", "src_label", "src_key", "trg_label", "trg_key").withColumn("r", F.explode(F.filter(rules, fits)))
        side = lambda way, x: F.when(way, F.col(f"src_{x}")).otherwise(F.col(f"trg_{x}"))
        fwd = F.col("r.forward")
        rows = e.select(side(fwd, "label").alias("near_label"), side(fwd, "key").alias("near_key"), side(~fwd, "label").alias("label"), side(~fwd, "key").alias("key"), F.col("r.rel").alias("kind"), (fwd == F.col("r.straight")).alias("out"), F.col("r.depth").alias("depth"))
        rows = rows.join(start.select("seed", F.col("label").alias("near_label"), F.col("key").alias("near_key"), F.col("id").alias("near_id")), ["near_label", "near_key"])
        rows = rows.join(known, ["label", "key"])
        ends = [F.when(F.col("out"), F.col(x)).otherwise(F.col(y)).alias(z) for x, y, z in (("near_id", "id", "src_id"), ("id", "near_id", "trg_id"))]
        return rows.select("seed", "label", "key", "id", "kind", *ends, "depth")

    start = found.join(known, ["label", "key"]).select("seed", "label", "key", "id")
    rows = near(start, wanted, own)
    if label == "ThreatActor":  # what the actor's malware uses
        rule = F.array(F.struct(*[F.lit(v).alias(n) for n, v in zip(names, (2, "IMPLEMENTS_TECHNIQUE", True, "Technique", "uses", True))]))
        rows = rows.unionByName(near(rows.where("kind = 'attributed-to' AND label = 'Malware'").select("seed", "label", "key", "id").distinct(), rule, ["Malware"]))
    none, place, ends = (lambda n: F.lit(None).cast("string").alias(n)), ["label", "key", "id"], ["kind", "src_id", "trg_id"]
    own_rows = start.select("seed", *place, *map(none, ends), F.lit(1).alias("depth"))
    both = F.explode(F.array(F.struct(*place, *map(none, ends)), F.struct(*map(none, place), *ends)))
    return own_rows.unionByName(rows.select("seed", both.alias("m"), "depth").select("seed", "m.*", "depth"))


def bundle_objects(held: DataFrame, told: DataFrame, now: Column) -> DataFrame:
    """(seed, id, object, depth) of members ``held`` and all nodes' objects ``told`` (label, key, object), each id of a seed once: of a vulnerability that two
    labels have, the Vulnerability's object."""
    own = held.where("kind IS NULL").groupBy("seed", "label", "key", "id").agg(F.min("depth").alias("depth")).join(told.hint("merge"), ["label", "key"])
    own = own.groupBy("seed", "id").agg(F.min(F.struct((F.col("label") == "CVE").alias("late"), "object")).alias("b"), F.min("depth").alias("depth")).select("seed", "id", "b.object", "depth")
    rel = held.where("kind IS NOT NULL").groupBy("seed", "kind", "src_id", "trg_id").agg(F.min("depth").alias("depth"))
    ends = (F.col("kind"), F.col("src_id"), F.col("trg_id"))
    return own.unionByName(rel.select("seed", relationship_id(*ends).alias("id"), relationship(*ends, now).alias("object"), "depth"))


def bundle_ids(rows: DataFrame, depths: list[int] | None = None) -> DataFrame:
    """(seed, n_objects, bundle_id) of (seed, id). The id is drawn from a hash over the sorted ids, each once, so equal content has equal ids; a
    task reads a seed's ids as a stream and holds none of them. With ``depths``, of (seed, id, depth): also depth, a row for the bundle of each of them,
    which are the ids of at most that depth, all in one pass."""
    wanted = depths or [0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = last = states = None

        def out() -> pa.RecordBatch:
            held = [(d, *s) for d, s in zip(wanted, states) if s[1]]
            for _, h, _n in held:
                h.update(b'"]')
            return pa.RecordBatch.from_arrays([pa.array([at] * len(held), pa.string()), pa.array([d for d, _, _ in held], pa.int32()), pa.array([n for _, _, n in held], pa.int64()), pa.array([h.hexdigest() for _, h, _ in held], pa.string())], names=["seed", "depth", "n_objects", "hash"])

        for b in batches:
            seeds_, ids, deep = (b.column(k).to_pylist() for k in ("seed", "id", "depth"))
            cuts = [0, *(k for k in range(1, len(seeds_)) if seeds_[k] != seeds_[k - 1]), len(seeds_)]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                if states is None or seeds_[i] != at:
                    if states is not None:
                        yield out()
                    at, last, states = seeds_[i], None, [[hashlib.sha256(b'["'), 0] for _ in wanted]
                once = [k for k in range(i, j) if ids[k] != (ids[k - 1] if k > i else last)]
                last = ids[j - 1]
                for d, state in zip(wanted, states):
                    some = [ids[k] for k in once if deep[k] <= d]
                    if some:
                        state[0].update(('","' * bool(state[1]) + '","'.join(some)).encode())
                        state[1] += len(some)
        if states is not None:
            yield out()

    depth = F.col("depth") if depths else F.lit(0).alias("depth")
    dealt = rows.select("seed", "id", depth).repartition("seed").sortWithinPartitions("seed", "id", "depth")
    found = dealt.mapInArrow(run, "seed string, depth int, n_objects long, hash string")
    return found.select(*(["depth"] if depths else []), "seed", "n_objects", F.concat(F.lit("bundle--"), uuid5(F.col("hash"))).alias("bundle_id"))


def _held(nodes: DataFrame, edges: DataFrame, label: str, asked: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Ids of managed nodes, written once, and ``members``."""
    known = materialize(identified(nodes.where("managed")).select("label", "key", "id"), "ids")
    return known, members(known, edges, seeds(nodes, label, asked), label)


def export_ids(nodes: DataFrame, edges: DataFrame, label: str, asked: DataFrame | None = None) -> DataFrame:
    """(seed, id, depth) of the bundles of ``export`` without their objects, for ``bundle_ids``; an id may come more than once."""
    id_ = F.coalesce("id", relationship_id(F.col("kind"), F.col("src_id"), F.col("trg_id"))).alias("id")
    return _held(nodes, edges, label, asked)[1].select("seed", id_, "depth")


def export(nodes: DataFrame, edges: DataFrame, claims: DataFrame, label: str, now: Column, depth: int = 2, asked: DataFrame | None = None) -> DataFrame:
    """(seed, id, object, depth) of the bundles of all nodes of ``label``, or of those asked for (``seeds``); a bundle of depth 1 are the rows of
    depth 1."""
    known, held = _held(nodes, edges, label, asked)
    told = objects(with_source_times(_filled(nodes).join(known.hint("merge"), ["label", "key"]), claims), now)
    return bundle_objects(held.where(F.col("depth") <= depth), told.select("label", "key", "object"), now)


def write_bundles(rows: DataFrame, path: str, source: str) -> None:
    """Bundles as text under ``path``: its files, one after another by name, are one bundle after another in the order of seeds, a line for its head, for
    each object in the order of ids, and for its end. A large bundle goes over several files. Equal rows give equal text."""
    lines = rows.select("seed", F.lit(1).alias("part"), "id", F.col("object").alias("line"))
    heads = bundle_ids(rows)
    own = F.to_json(F.struct(F.lit(source).alias("producer"), F.lit("2.1").alias("spec_version")))
    head = heads.select("seed", F.lit(0).alias("part"), F.lit("").alias("id"), F.concat(F.lit('{"type":"bundle","id":"'), "bundle_id", F.lit('","x_kg_source":'), own, F.lit(',"objects":[')).alias("line"))
    last = rows.groupBy("seed").agg(F.max("id").alias("__last"))
    lines = lines.join(last, "seed").withColumn("line", F.concat("line", F.when(F.col("id") == F.col("__last"), "").otherwise(","))).drop("__last")
    end = heads.select("seed", F.lit(2).alias("part"), F.lit("").alias("id"), F.lit("]}").alias("line"))
    order = ["seed", "part", "id"]
    head.unionByName(lines).unionByName(end).repartitionByRange(*order).sortWithinPartitions(*order).select("line").write.text(path)


def attribute_object(a: Column, zones: Column, now: Column) -> Column:
    """struct<id, object> of one staging attribute (struct of uuid, type, value, comment, tags, first_seen, last_seen, timestamp: times as timestamps) in an event of
    ``zones``; NULL for an empty value and for types and texts that stand for nothing."""
    value, kind, uuid = a["value"], a["type"], a["uuid"]
    own = F.coalesce(a["tags"], F.array().cast("array<string>"))
    labels = F.transform(zone_fold(F.concat(zones, G.zones_of(own))), lambda z: F.concat(F.lit("zone:"), z))
    iso = lambda x: F.date_format(x, "yyyy-MM-dd'T'HH:mm:ssxxx")
    tail = [iso(a["first_seen"]).alias("x_kg_first_seen_at_source"), iso(a["last_seen"]).alias("x_kg_last_seen_at_source"), iso(a["timestamp"]).alias("x_kg_attribute_timestamp")]
    ident = lambda t: F.concat(F.lit(t + "--"), uuid)

    def made(t: str, fields: list[Column], observed: bool = False) -> Column:
        head = [F.lit(t).alias("type"), F.lit("2.1").alias("spec_version"), ident(t).alias("id")]
        if observed:
            body = [*fields, labels.alias("x_kg_zones")]
        else:
            body = [*fields, labels.alias("labels"), iso(now).alias("created"), iso(now).alias("modified")]
        return F.struct(ident(t).alias("id"), F.to_json(F.struct(*head, *body, *tail)).alias("object"))

    after = lambda prefix: F.transform(F.filter(own, lambda t: t.startswith(prefix)), lambda t: F.trim(F.substring(t, len(prefix) + 1, 1 << 30)))
    comment = F.coalesce(a["comment"], F.lit(""))
    name, text = value.alias("name"), comment.alias("description")
    coded = lambda pattern, k: F.regexp_extract(value, rf"^({pattern}):\s*(.+)$", k)
    reference = lambda pattern, place, end: F.array(F.struct(F.lit("mitre-attack").alias("source_name"), coded(pattern, 1).alias("external_id"), F.concat(F.lit(f"{ATTACK_URL}{place}/"), coded(pattern, 1), F.lit(end)).alias("url"))).alias("external_references")
    said = lambda pattern: F.trim(coded(pattern, 2)).alias("name")
    technique, tool, tactic = r"T\d{4}(?:\.\d{3})?", r"S\d{4}", r"TA\d{4}"
    used = G.meta_list(comment, "MITRE_USES_TECHNIQUES:", "t")
    behind = F.when(F.size(used) > 0, F.coalesce(_said(F.trim(F.regexp_extract(comment, r"\n([\s\S]*)$", 1))), comment)).otherwise(comment)
    worms = after("malware-type:")
    observed = {
        "ipv4-addr": kind.isin("ip-dst", "ip-src", "ipv4"), "ipv6-addr": kind == "ipv6", "domain-name": kind.isin("domain", "hostname"), "url": kind == "url", "email-addr": kind == "email-src",
    }
    out = F.when(F.coalesce(value == "", F.lit(True)), None)
    for t, here in observed.items():
        out = out.when(here, made(t, [value.alias("value")], True))
    for h in ("md5", "sha1", "sha256", "sha512"):
        out = out.when(kind == h, made("file", [F.struct(value.alias(h.upper())).alias("hashes")], True))
    out = out.when(kind == "vulnerability", made("vulnerability", [name, text])).when(kind == "threat-actor", made("threat-actor", [name, text, F.array(F.lit("hacker")).alias("threat_actor_types")]))
    out = out.when(kind == "malware-type", made("malware", [name, text, F.lit(True).alias("is_family"), F.when(F.size(worms) > 0, worms).otherwise(F.array(F.lit("trojan"))).alias("malware_types")]))
    is_ = lambda pattern: (kind == "text") & (coded(pattern, 1) != "")
    out = out.when(is_(technique), made("attack-pattern", [said(technique), text, reference(technique, "techniques", "/")]))
    out = out.when(is_(tool), made("tool", [said(tool), behind.alias("description"), reference(tool, "software", "/"), _listed(used).alias("x_kg_uses_techniques")]))
    return out.when(is_(tactic), made("x-mitre-tactic", [said(tactic), text, reference(tactic, "tactics", "/"), F.lit("tactic").alias("x_kg_mitre_kind")]))


def event_objects(events: DataFrame, now: Column) -> DataFrame:
    """(event_id, place, id, object) of staging events (id, uuid, info, tags, attributes): a report that refers to all objects of the event, at
    place 0, and an object for each attribute that stands for one. An event's attributes are a list of its row already, so nothing is
    shuffled. Null lists are empty; an event of nothing is a report without references."""
    none = F.array().cast("array<string>")
    event_zones = G.zones_of(F.coalesce("tags", none))
    rows = events.withColumn("__o", F.filter(F.transform("attributes", lambda a: attribute_object(a, event_zones, now)), lambda o: o.isNotNull()))
    refs = F.coalesce(F.transform("__o", lambda o: o["id"]), none)
    at = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ssxxx")
    ident, info = F.concat(F.lit("report--"), "uuid"), F.coalesce("info", F.lit("Event"))
    report = F.to_json(F.struct(F.lit("report").alias("type"), F.lit("2.1").alias("spec_version"), ident.alias("id"), at.alias("created"), at.alias("modified"), at.alias("published"), info.alias("name"),
                                F.concat(F.lit("Event "), F.col("id").cast("string"), F.lit(": "), info).alias("description"), F.array(F.lit("threat-report")).alias("report_types"), refs.alias("object_refs"), F.transform(event_zones, lambda z: F.concat(F.lit("zone:"), z)).alias("labels")))
    every = F.concat(F.array(F.struct(ident.alias("id"), report.alias("object"))), F.coalesce("__o", F.array()))
    return rows.select(F.col("id").alias("event_id"), F.posexplode(every).alias("place", "o")).select("event_id", "place", "o.id", "o.object")
