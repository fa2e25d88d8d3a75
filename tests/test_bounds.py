"""Plans and files that keep the work of a task and what is shuffled in bounds."""

import glob

from pyspark.sql import functions as F

from sigilgraph.operators import link as L
from sigilgraph.operators import store
from sigilgraph.operators.store import KeyedTable, Rules
from sigilgraph.plans import catalog
from sigilgraph.session import bounded_tasks, scratch_path

SF = "/root/testdata/sf0.001"


def planned(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def scans(df, column):
    return sum("Relation [" in line and column in line for line in planned(df).splitlines())


def test_labels_are_made_from_attributes_that_are_written_once(spark):
    assert scans(catalog.queries()["M5_all_labels"](spark, SF), "l_orderkey") == 0


def test_single_edges_read_the_attributes_once(spark):
    assert scans(catalog.queries()["M9_all_single_edges"](spark, SF), "l_orderkey") == 1


def test_a_bucket_is_written_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(store, "SLICE", 50, raising=False)
    table = KeyedTable(spark, scratch_path(spark, "t"), Rules(["k"], "at", last=["v"]), buckets=2)
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("at"), (F.col("id") * 2).alias("v"))
    assert table.upsert(rows).inserted == 1000
    assert table.upsert(rows.where("k < 600").withColumns({"at": F.lit(2), "v": F.col("k")})).changed == 600
    assert {(r["k"], r["v"]) for r in table.read().collect()} == {(k, k if k < 600 else 2 * k) for k in range(1000)}
    for b in (0, 1):
        assert len(glob.glob(f"{table.path.removeprefix('file://')}/v2/bucket={b}/*.parquet")) > 3


def test_pairs_of_parts_and_texts_are_not_shuffled(spark, frame):
    needles = spark.range(300).select(F.col("id").alias("needle"), F.concat(F.lit("part-"), (F.col("id") % 2).cast("string")).alias("part"))
    texts = spark.range(200).select(F.col("id").alias("text_id"), F.concat(F.lit("a part-"), (F.col("id") % 4).cast("string")).alias("text"))
    got = L.contains_join(needles, texts)
    assert "Aggregate" not in planned(got).split("Join")[0]
    assert sorted(map(tuple, got.collect())) == [(n, t) for n in range(300) for t in range(200) if n % 2 == t % 4]


def test_a_key_that_many_rows_have_is_split(spark):
    bounded_tasks(spark)
    assert spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")) <= 64 << 20


def test_bundles_hold_what_their_rules_name(spark):
    """A technique's export joins no attributes: none of its rules has their edges or nodes."""
    from sigilgraph.operators import bundles as B
    from sigilgraph.plans import bundling

    labels, types = B.held_kinds("Technique")
    t = catalog.Tables(spark, SF)
    kept = bundling.edges(t).where(F.col("type").isin(types)).unionByName(bundling.nodes(t).where(F.col("label").isin(labels)).select("label", "key"), allowMissingColumns=True)
    assert scans(kept, "l_orderkey") == 0 and scans(bundling.edges(t), "l_orderkey") > 0
    assert B.held_kinds("Vulnerability") == (["CVE", "Indicator", "Sector", "Vulnerability"], ["AFFECTS", "EXPLOITS"])
    assert B.held_kinds("ThreatActor") == (["Campaign", "Malware", "Technique", "ThreatActor"], ["ATTRIBUTED_TO", "EMPLOYS_TECHNIQUE", "IMPLEMENTS_TECHNIQUE", "RUNS"])


def test_normal_forms_need_no_python(spark, frame):
    import unicodedata

    from sigilgraph.functions.ident import nfc

    texts = ["", None, "abc", "é", "é", "한", "Å̧", "Ω", "\U0001d15e", "ﬁ"]
    rows = frame([(x,) for x in texts], "t string").select("t", nfc(F.col("t")).alias("n"))
    assert [r["n"] for r in rows.collect()] == [None if x is None else unicodedata.normalize("NFC", x) for x in texts]
    assert "EvalPython" not in rows._jdf.queryExecution().executedPlan().toString()


def test_the_id_of_a_relation_hashes_each_end_once(spark):
    plan = planned(catalog.queries()["X7_relation_ids"](spark, SF))
    assert plan.count("sha1(") == 3
    assert "sha1(" not in plan.split("Join")[0].split("relationship:")[1]


def test_all_shared_members_count(spark):
    """Also those of a target that has very many (F9, F10)."""
    rows = spark.range(1000).select(F.col("id").alias("event_id"), (F.col("id") % 2).alias("one"))
    got = L.shared_members(rows.select(F.col("one").alias("src"), "event_id"), rows.select(F.lit(7).alias("trg"), "event_id"), "event_id")
    assert sorted(map(tuple, got.collect())) == [(0, 7, 500), (1, 7, 500)]


def test_counts_of_steps_hold_all_pairs_of_an_event(spark):
    """At sf0.01 a malware has some 600 events, of which 200 were counted (F9, F10)."""
    sf = "/root/testdata/sf0.01"
    t = catalog.Tables(spark, sf)
    a = t.attribute.select("event_id", "indicator_id", "malware_id")
    pairs = a.select("event_id", "indicator_id").join(a.select("event_id", "malware_id"), "event_id").select("indicator_id", "malware_id").distinct().count()
    steps = {r["step"]: r["edges"] for r in catalog.queries()["R5_step_counts"](spark, sf).collect()}
    assert steps["4 co-occurrence"] == catalog.queries()["J4_cooccurrence"](spark, sf).count() == pairs


def test_pairs_of_an_event_are_counted_without_events(spark, frame):
    items = frame([(e, k, key) for e in (1, 2, 2, 3) for k, key in (("a", "x"), ("b", "y"), ("b", "z"))] + [(3, "c", "x")], "event_id int, kind string, key string")
    got = L.event_relations(items, [("R", "a", "b")])
    assert "distinct" not in planned(got).lower()
    assert sorted((r["src"], r["trg"], r["events"]) for r in got.collect()) == [("x", "y", 3), ("x", "z", 3)]
    # A type of two rules tells its events apart: in event 3, x stands for both kinds.
    both = L.event_relations(items, [("R", "a", "b"), ("R", "c", "b")])
    assert sorted((r["src"], r["trg"], r["events"]) for r in both.collect()) == [("x", "y", 3), ("x", "z", 3)]


def test_raw_records_are_packed_and_dedup_takes_what_is_asked_for(spark):
    from sigilgraph.plans import readers

    path = readers._text(catalog.Tables(spark, SF), spark.range(1000).select(F.repeat(F.lit("record "), F.lit(50)).alias("value")))
    files = glob.glob(f"{path.removeprefix('file://')}/part-*")
    assert files and all(f.endswith(".gz") for f in files)
    assert spark.read.text(path).distinct().count() == 1 and spark.read.text(path).count() == 1000
    plan = planned(catalog.queries()["S17_P10_parse"](spark, SF))
    assert "OTX_META" not in plan and "key" in plan
