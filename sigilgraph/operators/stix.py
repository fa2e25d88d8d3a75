"""STIX objects, relations and bundles as JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ident import STIX_TYPES, natural_key, uuid5
from ..functions.scalars import stix_pattern, stix_time


def stix_id(label: str, fields: list[Column]) -> Column:
    kind = STIX_TYPES.get(label, "x-kg-" + label.lower())
    return F.concat(F.lit(kind + "--"), uuid5(natural_key(fields, kind)))


def indicator_object(kind: Column, value: Column, valid_from: Column, confidence: Column, zones: Column) -> Column:
    return F.to_json(F.struct(F.lit("indicator").alias("type"), F.lit("2.1").alias("spec_version"), stix_id("Indicator", [kind, value]).alias("id"), stix_pattern(kind, value).alias("pattern"), F.lit("stix").alias("pattern_type"), stix_time(valid_from).alias("valid_from"), F.round(confidence * 100).cast("int").alias("confidence"), F.array_sort(zones).alias("x_kg_zones")))


def named_object(label: str, name: Column, **more: Column) -> Column:
    kind = STIX_TYPES[label]
    return F.to_json(F.struct(F.lit(kind).alias("type"), F.lit("2.1").alias("spec_version"), stix_id(label, [name]).alias("id"), name.alias("name"), *[c.alias(k) for k, c in more.items()]))


def relation_id(kind: Column, src: Column, trg: Column) -> Column:
    """Id of a relation of an edge type (ATTRIBUTED_TO is attributed-to) between two objects."""
    return F.concat(F.lit("relationship--"), uuid5(F.lower(F.concat(F.lit("relationship:"), F.concat_ws("|", src, F.replace(kind, F.lit("_"), F.lit("-")), trg)))))


def relation_object(kind: Column, src: Column, trg: Column) -> Column:
    return F.to_json(F.struct(F.lit("relationship").alias("type"), F.lit("2.1").alias("spec_version"), relation_id(kind, src, trg).alias("id"), F.lower(F.replace(kind, F.lit("_"), F.lit("-"))).alias("relationship_type"), src.alias("source_ref"), trg.alias("target_ref")))


def object_of(label: Column, node_id: Column, name: Column) -> Column:
    """The object of a node that a name describes, its type taken from the label."""
    kinds = F.create_map(*[F.lit(x) for kv in STIX_TYPES.items() for x in kv])
    return F.to_json(F.struct(kinds[label].alias("type"), F.lit("2.1").alias("spec_version"), node_id.alias("id"), name.alias("name")))


def neighbour_objects(nodes: DataFrame, edges: DataFrame, label: str) -> DataFrame:
    """(seed, id): ids of what each node of ``label`` exports: itself, its neighbours in either direction and the relations to them.

    nodes: label, key, id; edges: type, src_label, src_key, trg_label, trg_key. Edges with an unknown end are left out. A seed's rows are
    never gathered here, so writers can deal them out by seed and id."""
    end = lambda p: nodes.select(F.col("label").alias(f"{p}_label"), F.col("key").alias(f"{p}_key"), F.col("id").alias(f"{p}_id"))
    near = edges.where((F.col("src_label") == label) | (F.col("trg_label") == label))
    known = near.join(end("src"), ["src_label", "src_key"]).join(end("trg"), ["trg_label", "trg_key"])
    known = known.withColumn("rel", relation_id(F.col("type"), F.col("src_id"), F.col("trg_id")))
    ways = [known.where(F.col(f"{a}_label") == label).select(F.col(f"{a}_key").alias("seed"), F.explode(F.array(f"{b}_id", "rel")).alias("id")) for a, b in (("src", "trg"), ("trg", "src"))]
    return nodes.where(F.col("label") == label).select(F.col("key").alias("seed"), "id").unionByName(ways[0]).unionByName(ways[1]).distinct()


def bundle_ids(members: DataFrame, group: str) -> DataFrame:
    """(group, n_objects, bundle_id) of members (group, id); see bundles.py."""
    from .bundles import bundle_ids as ids

    return ids(members.select(F.col(group).cast("string").alias("seed"), "id")).withColumnRenamed("seed", group)


def bundles(objects: DataFrame, group: str) -> DataFrame:
    """One bundle for each group of (group, id, object): objects once, by id; the bundle's id is drawn from the ids, so equal content has
    equal ids."""
    rows = objects.groupBy(group, "id").agg(F.min("object").alias("object"))
    parts = F.array_sort(F.collect_list(F.struct("id", "object")))
    g = rows.groupBy(group).agg(parts.alias("p"))
    ids = F.to_json(F.transform("p", lambda x: x["id"]))
    body = F.array_join(F.transform("p", lambda x: x["object"]), ",")
    return g.select(group, F.size("p").alias("n_objects"), F.concat(F.lit("bundle--"), uuid5(F.sha2(ids, 256))).alias("bundle_id"), F.concat(F.lit('{"type":"bundle","objects":['), body, F.lit("]}")).alias("bundle"))


def read_bundle(objects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entities, relations) of bundle objects as JSON text (column object): entities stix_id, type, name, value; relations type, src and trg as
    (type, name) through two joins on the id map. Relations with an unknown end are dropped."""
    get = lambda p: F.get_json_object("object", "$." + p)
    from ..functions.scalars import pattern_value

    base = objects.select(get("id").alias("stix_id"), get("type").alias("type"), get("name").alias("name"), get("pattern").alias("pattern"), get("relationship_type").alias("rel"), get("source_ref").alias("s"), get("target_ref").alias("t"))
    entities = base.where(F.col("type") != "relationship").select("stix_id", "type", "name", pattern_value(F.col("pattern")).alias("value"))
    end = lambda p: entities.select(F.col("stix_id").alias(p), F.col("type").alias(p + "_type"), F.coalesce("name", "value").alias(p + "_name"))
    relations = base.where(F.col("type") == "relationship").join(end("s"), "s").join(end("t"), "t").select(F.col("rel").alias("type"), "s_type", "s_name", "t_type", "t_name")
    return entities, relations


def load_bundle(objects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and relations of a bundle as they are stored: each entity once by type and name, with the confidence of its type."""
    entities, relations = read_bundle(objects)
    confidence = F.when(F.col("type") == "x-mitre-tactic", 1.0).when(F.col("type") == "attack-pattern", 0.8).otherwise(0.7)
    nodes = entities.select("type", F.coalesce("name", "value").alias("name"), confidence.alias("confidence"))
    return nodes.dropna(subset=["name"]).distinct(), relations.distinct()
