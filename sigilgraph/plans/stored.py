"""Queries of stored tables: batches that arrive out of order are upserted, and the end state is held against SQL over all claims."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.store import KeyedTable, Rules
from ..session import scratch_path
from .catalog import query

_FOLD = "CASE WHEN len(list_filter({0}, lambda x: x <> 'global')) > 0 THEN array_to_string(list_sort(list_filter({0}, lambda x: x <> 'global')), '|') ELSE array_to_string(list_sort({0}), '|') END"
#: Batches of claims, the later ones first, and one of them twice.
BATCHES = ["event_id % 3 = 2", "event_id % 3 = 0", "event_id % 3 = 2", "event_id % 3 = 1"]


def _stored(t, rules: Rules, claims: DataFrame, batches: list[str] = BATCHES, direct: bool = False) -> tuple[KeyedTable, list]:
    table = KeyedTable(t.spark, scratch_path(t.spark, "table"), rules)
    return table, [table.upsert(claims.where(b), direct) for b in batches]


NODES = Rules(["indicator_id"], "seq", highest=["confidence"], earliest=["first_seen"], latest=["last_seen"], first=["tag"], last=["last_zone"], sets=["sources", "zones"])


def node_claims(t) -> DataFrame:
    return t.attribute.select("indicator_id", "event_id", "seq", "confidence", F.col("seen").alias("first_seen"), F.col("seen").alias("last_seen"), F.col("source_name").alias("tag"), F.col("zone").alias("last_zone"), F.array("source_name").alias("sources"), F.array("zone").alias("zones"))


@query("K2_M1_stored_nodes", f"""WITH a AS (SELECT indicator_id, max(confidence) AS confidence, min(seen) AS f, max(seen) AS l, arg_min(source_name, seq) AS tag, arg_max(zone, seq) AS last_zone, list_sort(list_distinct(list(source_name))) AS sources, list_distinct(list(zone)) AS z FROM attribute GROUP BY indicator_id)
  SELECT indicator_id, confidence, epoch(f)::BIGINT AS first_seen, epoch(l)::BIGINT AS last_seen, tag, last_zone, array_to_string(sources, '|') AS sources, {_FOLD.format('z')} AS zones FROM a""")
def stored_nodes(t):
    from ..functions.scalars import zone_fold

    t.written("attribute", ["indicator_id", "event_id", "seq", "confidence", "seen", "source_name", "zone"])
    table, _ = _stored(t, NODES, node_claims(t))
    return table.read().select("indicator_id", "confidence", F.unix_timestamp("first_seen").alias("first_seen"), F.unix_timestamp("last_seen").alias("last_seen"), "tag", "last_zone", F.array_join("sources", "|").alias("sources"), F.array_join(zone_fold(F.col("zones")), "|").alias("zones"))


@query("M2_stored_provenance", "SELECT indicator_id, source_name, epoch(min(seen))::BIGINT AS first, epoch(max(seen))::BIGINT AS last, arg_min(zone, seq) AS raw FROM attribute GROUP BY indicator_id, source_name")
def stored_provenance(t):
    rules = Rules(["indicator_id", "source_name"], "seq", earliest=["first"], latest=["last"], first=["raw"])
    a = t.written("attribute", ["indicator_id", "source_name", "event_id", "seq", "seen", "zone"])
    table, _ = _stored(t, rules, a.select("indicator_id", "source_name", "event_id", "seq", F.col("seen").alias("first"), F.col("seen").alias("last"), F.col("zone").alias("raw")))
    return table.read().select("indicator_id", "source_name", F.unix_timestamp("first").alias("first"), F.unix_timestamp("last").alias("last"), "raw")


@query("M8_stored_edges", """SELECT indicator_id, malware_id, CASE WHEN malware_id % 4 = 0 THEN 0.3e0 ELSE arg_max(confidence, seq) END AS confidence, malware_id % 4 = 0 AS calibrated, array_to_string(list_sort(list_distinct(list(source_name))), '|') AS sources, count(DISTINCT event_id) AS events
  FROM attribute GROUP BY indicator_id, malware_id""")
def stored_edges(t):
    """Edges whose confidence the last writer sets, until they are calibrated; a calibration comes between two batches and stays. The
    events of an edge are rows of a table of their own."""
    keys = ["indicator_id", "malware_id"]
    rules = Rules(keys, "seq", last=["confidence", "calibrated"], sets=["sources"])
    a = t.written("attribute", [*keys, "event_id", "seq", "confidence", "source_name"])
    claims = a.select(*keys, "event_id", "seq", "confidence", F.lit(None).cast("double").alias("calibrated"), F.array("source_name").alias("sources"))
    frozen = t.indicates.where("malware_id % 4 = 0").select(*keys, F.lit(0).cast("long").alias("seq"), F.lit(None).cast("double").alias("confidence"), F.lit(0.3).alias("calibrated"), F.array().cast("array<string>").alias("sources"))
    # Few claims share an edge, and fewer a member of one.
    edges, _ = _stored(t, rules, claims, BATCHES[:2], direct=True)
    edges.upsert(frozen)
    for b in BATCHES[2:]:
        edges.upsert(claims.where(b), direct=True)
    members, _ = _stored(t, Rules([*keys, "event_id"]), a.select(*keys, "event_id"), direct=True)
    events = members.read().groupBy(*keys).agg(F.count("*").alias("events"))
    told = edges.read().select(*keys, F.coalesce("calibrated", "confidence").alias("confidence"), F.col("calibrated").isNotNull().alias("calibrated"), F.array_join("sources", "|").alias("sources"))
    return told.join(events, keys).select(*keys, "confidence", "calibrated", "sources", "events")


_TOLD = """b AS (SELECT indicator_id, CASE event_id % 3 WHEN 2 THEN 1 WHEN 0 THEN 2 ELSE 4 END AS version, count(*) AS n, max(seen) AS c FROM attribute GROUP BY 1, 2),
  k AS (SELECT *, max(c) OVER (PARTITION BY indicator_id ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS old FROM b),
  w AS (SELECT version, sum(n)::BIGINT AS asked, count(*) AS touched, count(*) FILTER (old IS NULL) AS inserted, count(*) FILTER (old IS NULL OR c > old) AS changed FROM k GROUP BY version)"""


@query("M15_write_counts", f"WITH {_TOLD} SELECT version, asked, touched, inserted, changed FROM w UNION ALL SELECT 3, asked, touched, 0, 0 FROM w WHERE version = 1")
def write_counts(t):
    """What each batch was asked for, touched, inserted and changed; the third repeats the first and changes nothing."""
    a = t.written("attribute", ["indicator_id", "event_id", "seen"])
    table, told = _stored(t, Rules(["indicator_id"], latest=["last_seen"]), a.select("indicator_id", "event_id", F.col("seen").alias("last_seen")))
    return t.spark.createDataFrame([(w.version, w.asked, w.touched, w.inserted, w.changed) for w in told], "version int, asked long, touched long, inserted long, changed long")


@query("K2_changed_since", f"WITH {_TOLD} SELECT indicator_id, epoch(max(c))::BIGINT AS last_seen, min(version)::INTEGER AS created, 4 AS changed FROM b GROUP BY indicator_id HAVING indicator_id IN (SELECT indicator_id FROM k WHERE version = 4 AND (old IS NULL OR c > old))")
def changed_since(t):
    """What a consumer reads that knows the table as of version 3."""
    a = t.written("attribute", ["indicator_id", "event_id", "seen"])
    table, _ = _stored(t, Rules(["indicator_id"], latest=["last_seen"]), a.select("indicator_id", "event_id", F.col("seen").alias("last_seen")))
    return table.read(since=3).withColumn("last_seen", F.unix_timestamp("last_seen"))
