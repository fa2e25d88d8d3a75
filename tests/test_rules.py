"""Backfills, weak links, job order, nested scores, zones, refusals and Unicode names on small fixtures."""

import pytest
from pyspark.sql import functions as F

from sigilgraph.functions import ident
from sigilgraph.operators import enrich as E
from sigilgraph.operators import link as L
from sigilgraph.operators import merge as M
from sigilgraph.operators import serve as V


def test_first_events_meet_malware(spark, frame):
    """An indicator with very many events counts its first ones only, whatever task they are in."""
    hot = spark.range(0, 30_000, 1, 8).select(F.lit("hot").alias("indicator"), F.format_string("e%05d", "id").alias("event_id"), F.col("id").alias("at"))
    rows = hot.unionByName(frame([("i", "e00000", 1), ("i", "e29999", 2), ("i", "", 0), ("i", None, 0)], "indicator string, event_id string, at long"))
    mal = frame([("a", "e00001"), ("b", "e00199"), ("c", "e00200"), ("d", "e29999"), ("d", "e29999"), ("e", "")], "malware string, event_id string")
    got = {(r["indicator"], r["malware"]) for r in L.event_cooccurrence(rows, mal).collect()}
    assert got == {("hot", "a"), ("hot", "b"), ("i", "d")}


def test_backfill_patterns(frame):
    ends = "type string, src_label string, src string, trg_label string, trg string"
    edges = [
        ("INDICATES", "Indicator", "i", "Malware", "m", "misp_cooccurrence"), ("INDICATES", "Indicator", "i", "Malware", "none", "misp_cooccurrence"), ("INDICATES", "Indicator", "i", "Malware", "f", "malware_family"), ("INDICATES", "Indicator", "i", "Malware", "t", "tag"),
        ("INDICATES", "Indicator", "i", "Malware", "n", None), ("EXPLOITS", "Indicator", "i", "CVE", "c", None), ("EXPLOITS", "Indicator", "i", "CVE", "done", None), ("AFFECTS", "CVE", "c", "Sector", "s", None), ("AFFECTS", "CVE", "nothing", "Sector", "s", None),
    ]
    events = [("Indicator", "i", "e3", 3), ("Indicator", "i", "e1", 1), ("Indicator", "i", "e2", 2), ("Indicator", "i", "e1", 9), ("Indicator", "i", None, 0), ("Malware", "m", "e3", 0), ("Malware", "m", "e2", 0), ("CVE", "c", "x", 1)]
    out = E.backfill_events(frame(edges, ends + ", match_type string"), frame([("EXPLOITS", "Indicator", "i", "CVE", "done")], ends), frame(events, "label string, key string, event_id string, at long"), 2)
    got = {}
    for r in out.collect():
        got.setdefault((r["pattern"], r["trg"]), set()).add(r["event_id"])
    assert got == {("indicates_cooccurrence", "m"): {"e2", "e3"}, ("indicates_family_match", "f"): {"e1", "e2"}, ("exploits", "c"): {"e1", "e2"}, ("affects_vuln_to_sector", "s"): {"x"}}


def test_backfill_of_shared_events_meets_by_event(spark, frame, monkeypatch):
    """Sources with many events bring no row for each edge and event; a crowded event counts as any other."""
    ends = "type string, src_label string, src string, trg_label string, trg string"
    edges = frame([("INDICATES", "Indicator", f"i{k}", "Malware", f"m{j}", "misp_cooccurrence") for k in range(20) for j in range(20)], ends + ", match_type string")
    rows = [("Indicator", f"i{k}", f"e{k}-{n}", n) for k in range(20) for n in range(50)] + [("Indicator", f"i{k}", "big", 60 + k) for k in range(20)]
    rows += [("Malware", f"m{j}", "big", 0) for j in range(0, 20, 2)] + [("Malware", f"m{j}", f"e{j}-{n}", 0) for j in range(20) for n in (7, 8, 9)]
    events = frame(rows, "label string, key string, event_id string, at long")
    want = {(f"i{k}", f"m{k}", f"e{k}-{n}") for k in range(20) for n in (7, 8)} | {(f"i{k}", f"m{j}", "big") for k in range(20) for j in range(0, 20, 2) if k != j}
    for crowded in (64, 10):  # no event is crowded, then one
        monkeypatch.setattr(E, "CROWDED", crowded)
        out = E.backfill_events(edges, frame([], ends), events, 2)
        assert {(r["src"], r["trg"], r["event_id"]) for r in out.collect()} == want
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("event_id") and ("LeftAnti" in plan) == (crowded == 10)


def test_jobs_run_in_order(spark):
    rows = lambda: spark.range(2)
    broken = lambda: spark.range(1).select("nothing")
    got = [tuple(r) for r in E.run_jobs({"bridge": rows, "campaigns": broken, "calibration": rows, "decay": rows}).collect()]
    assert got == [("bridge", True, 2), ("campaigns", False, None), ("calibration", True, 2), ("decay", True, 2)]
    with pytest.raises(ValueError):
        E.run_jobs({"campaigns": rows, "bridge": rows, "calibration": rows, "decay": rows})


def test_invariants(frame):
    how = (frame([("m", "a"), ("n", "b"), ("o", "c")], "malware string, actor string"), frame([("m", 1), ("n", 2), ("o", 3)], "malware string, indicator long"))
    ind, src = frame([(1, True), (2, False), (3, True)], "indicator long, active boolean"), frame([(1,)], "x long")
    assert tuple(E.invariants(*how, ind, frame([("a",)], "actor string"), src).first()) == (2, 1, 3, 1, False)
    assert tuple(E.invariants(*how, ind, frame([("a",), ("c",), ("c",)], "actor string"), src).first()) == (2, 0, 3, 1, True)
    assert not E.invariants(*how, ind, frame([("a",), ("c",)], "actor string"), src.limit(0)).first()["ok"]


def test_nested_scores(frame):
    nodes = frame([("own", 0.0, None), ("none", None, "LOW"), ("two", None, "LOW"), ("gap", None, None)], "cve_id string, score double, severity string")
    kids = [("own", "v31", 9.0, "HIGH", "x"), ("two", "v2", 0.0, None, "x"), ("two", "v40", 8.0, "HIGH", "x"), ("gap", "v31", None, "HIGH", "x"), ("gap", "v40", 4.0, "MEDIUM", None), ("lost", "v2", 1.0, "LOW", "x")]
    out = {r["cve_id"]: r for r in V.with_scores(nodes, frame(kids, "cve_id string, version string, base_score double, base_severity string, vector_string string")).collect()}
    assert {k: (r["score"], r["severity"]) for k, r in out.items()} == {"own": (0.0, None), "none": (None, "LOW"), "two": (0.0, "LOW"), "gap": (4.0, "MEDIUM")}
    assert out["own"]["v31"]["base_score"] == 9.0 and out["own"]["v2"] is None and out["gap"]["v31"]["vector_string"] == "x"


def test_zones_of_all_labels(frame):
    rows = [("A", "1", "HIGH", ["x", "x", "y"], None, True), ("A", "2", "LOW", ["x"], "2024-01-02", True), ("B", "3", None, ["x"], "2024-01-03", True), ("B", "4", "HIGH", ["x"], None, False), ("B", "5", "HIGH", None, None, True), ("B", "6", "HIGH", ["x"], None, None)]
    nodes = frame(rows, "label string, key string, severity string, zones array<string>, last_updated string, managed boolean")
    assert [(r["zone"], r["rank"], r["key"]) for r in V.zone_threats(nodes, 2).orderBy("zone", "rank").collect()] == [("x", 1, "1"), ("x", 2, "3"), ("y", 1, "1")]
    assert [r["key"] for r in V.zone_threats(nodes, 0, "low").collect()] == ["2"]
    assert {r["zone"]: (r["total"], r["critical"], r["high"], r["low"]) for r in V.zone_summary(nodes).collect()} == {"x": (3, 0, 1, 1), "y": (1, 0, 1, 0)}


def test_refusals_by_source(frame):
    rows = frame([("NVD", "k"), ("NVD", " "), ("me", "k"), (None, "k")], "s string, k string")
    assert [r["refused"] for r in M.accepted(rows, ["k"], "s", ["NVD"]).collect()] == [None, "blank key", "unknown source", "unknown source"]


def test_union_lists_of_a_hot_key(spark, frame):
    rows = spark.range(0, 40_000, 1, 8).select(F.lit("k").alias("k"), F.col("id").alias("o"), F.array(F.concat(F.lit("m"), (F.col("id") % 3).cast("string")), F.lit(None).cast("string")).alias("l"))
    rows = rows.unionByName(frame([("k", -1, ["z", "m2"]), ("j", 0, None), ("i", 0, [])], "k string, o long, l array<string>"))
    assert {r["k"]: r["l"] for r in M.union_lists(rows, ["k"], "l", "o").collect()} == {"k": ["z", "m2", "m0", "m1"]}


def test_unicode_names(frame):
    rows = frame([("Café",), ("Café ",), ("Cafe",), (None,)], "n string")
    ids = [r["i"] for r in rows.select(ident.node_uuid("Malware", [F.col("n")]).alias("i")).collect()]
    assert ids[0] == ids[1] != ids[2] and ids[3]
    folds = [r["f"] for r in frame([("ＮＶＤ ",), ("Straße",), ("STRASSE",), (None,), ("ﬁn",)], "n string").select(ident.folded(F.col("n")).alias("f")).collect()]
    assert folds == ["nvd", "strasse", "strasse", None, "fin"]
    trusted = E.creator_trust(frame([(None, "ＮＶＤ"), (None, "Strasse"), (None, "x")], "creator_uuid string, creator_name string"), frame([("u", " nvd"), ("v", "Straße")], "uuid string, name string"))
    assert [r["trusted"] for r in trusted.orderBy("creator_name").collect()] == [True, False, True]


def test_labels_merge_in_any_spelling(frame):
    rows = [(1, "Evil ", 0.5, "a", ["x"], ["global"], None), (2, " EVIL", 0.9, "b", ["y", None], ["energy"], "d"), (3, "unknown", 1.0, "c", [], None, "e"), (4, None, 1.0, "c", None, None, "f"), (5, "evil", None, None, None, None, None)]
    out = M.merge_label("Malware", frame(rows, "seq long, name string, confidence double, tag string, aliases array<string>, zones array<string>, description string"), "seq").collect()
    assert len(out) == 1 and out[0]["name"] == "evil" and out[0]["confidence"] == 0.9 and out[0]["tag"] == "a" and out[0]["description"] == "d" and out[0]["zones"] == ["energy"]
    ind = M.merge_label("Indicator", frame([(1, "domain", "A.b"), (2, "domain", "a.B"), (3, "url", "A"), (4, "url", "a"), (5, "", "a")], "seq long, indicator_type string, value string"), "seq")
    assert {(r["indicator_type"], r["value"]) for r in ind.collect()} == {("domain", "a.b"), ("url", "A"), ("url", "a")}
