"""Keyed tables and relation definitions: order of batches, replays, refusals, hot keys and rows that go nowhere."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from sigilgraph.operators import dispatch as D
from sigilgraph.operators.store import KeyedTable, Rules, Written
from sigilgraph.session import scratch_path

RULES = Rules(["k", "j"], "seq", highest=["high"], earliest=["lo"], latest=["hi"], first=["tag"], last=["name"], sets=["zones"], counts=["n"])
SCHEMA = "k string, j long, seq long, high double, lo timestamp, hi timestamp, tag string, name string, zones array<string>, n long, extra string"


def claims(frame, seed, rows=60):
    r = random.Random(seed)
    none = lambda v: v if r.random() < 0.7 else None
    import datetime

    day = lambda: datetime.datetime(2024, 1, r.randint(1, 28))
    out = [(r.choice(["a", "b", "c", " ", None]), r.choice([1, 2, 2, 2, None]), r.randint(0, 9), none(r.choice([0.1, 0.9, float("nan")])), none(day()), none(day()), none(r.choice("xyz")), none(r.choice("xyz")), none([r.choice("pqr"), None]), 1, "e") for _ in range(rows)]
    return frame(out, SCHEMA)


def rows_of(table, **at):
    return sorted(str(r.asDict() | {"created": 0, "changed": 0}) for r in table.read(**at).collect())


def test_batches_in_any_order_give_one_table(spark, frame):
    batches = [claims(frame, s) for s in range(3)]
    seen = []
    for order in itertools.islice(itertools.permutations(range(3)), 0, 6, 2):
        table = KeyedTable(spark, scratch_path(spark, "t"), RULES, buckets=3)
        told = [table.upsert(batches[i]) for i in order]
        assert [w.version for w in told] == [1, 2, 3] and told[0].inserted == told[0].changed == told[0].touched
        seen.append(rows_of(table))
    assert seen[0] == seen[1] == seen[2]
    whole = KeyedTable(spark, scratch_path(spark, "t"), RULES, buckets=1)
    whole.upsert(batches[0].unionByName(batches[1]).unionByName(batches[2]))
    assert rows_of(whole) == seen[0]


def test_replays_versions_and_changes(spark, frame):
    rules = Rules(["k"], "seq", last=["name"], sets=["zones"])
    table = KeyedTable(spark, scratch_path(spark, "t"), rules, buckets=4)
    one = frame([("a", 1, "x", ["z"]), ("b", 1, "y", None), ("b", 0, "w", ["q"])], "k string, seq long, name string, zones array<string>")
    assert table.upsert(one) == Written(1, 3, 2, 2, 2)
    assert table.upsert(one) == Written(2, 3, 2, 0, 0)
    late = frame([("b", 2, "new", ["q"]), ("c", 0, None, None)], "k string, seq long, name string, zones array<string>")
    w = table.upsert(late)
    assert (w.asked, w.touched, w.inserted, w.changed) == (2, 2, 1, 2)
    assert {r["k"]: r["name"] for r in table.read().collect()} == {"a": "x", "b": "new", "c": None}
    assert {r["k"]: r["name"] for r in table.read(version=1).collect()} == {"a": "x", "b": "y"}
    assert {r["k"]: (r["created"], r["changed"]) for r in table.read(since=w.version - 1).collect()} == {"b": (1, w.version), "c": (w.version, w.version)}


def test_refusals(spark, frame):
    rules = Rules(["k"], highest=["c"])
    table = KeyedTable(spark, scratch_path(spark, "t"), rules)
    with pytest.raises(ValueError):
        table.read()
    with pytest.raises(ValueError):  # a write that was asked for rows and can write none
        table.upsert(frame([(" ", 1.0), (None, 2.0)], "k string, c double"))
    assert table.upsert(frame([], "k string, c double")).version == 0
    table.upsert(frame([("a", 1.0)], "k string, c double"))
    assert table.upsert(frame([], "k string, c double")).version == 1
    with pytest.raises(ValueError):
        KeyedTable(spark, table.path, rules, buckets=5).manifest()
    with pytest.raises(ValueError):
        KeyedTable(spark, table.path, Rules(["k"], highest=["changed"]))


def test_only_touched_buckets_are_written(spark, frame):
    table = KeyedTable(spark, scratch_path(spark, "t"), Rules(["k"], highest=["c"]), buckets=8)
    table.upsert(frame([(str(i), 1.0) for i in range(50)], "k string, c double"))
    before = table.manifest()
    table.upsert(frame([("7", 2.0)], "k string, c double"))
    after = table.manifest()
    assert sorted(before) == sorted(after) and sum(after[b] == 2 for b in after) == 1
    assert table.read().count() == 50


def test_one_key_with_most_claims(spark):
    rules = Rules(["k"], "id", highest=["id"], last=["v"])
    table = KeyedTable(spark, scratch_path(spark, "t"), rules)
    rows = spark.range(0, 50_000, 1, 16).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 100).cast("string"))).alias("k"), "id", F.col("id").alias("v"))
    w = table.upsert(rows)
    assert (w.asked, w.touched) == (50_000, 101)
    assert table.read().where("k = 'hot'").first()["v"] == 49_999


def test_embedded_definitions(frame):
    rows = [
        (1, 1, "ip-dst", " 10.0.0.1 ", ["confidence:low", "malware-type:Evil", "malware-type: ", 'misp-galaxy:malware="Other"', "exploits:cve-2024-1", "exploits:x", "sector:Energy"]),
        (1, 2, "threat-actor", "Bear", ["mitre-attack:technique:T1059", "mitre-attack:technique:none"]),
        (1, 3, "malware-type", "Evil", ["threat-actor:Bear"]),
        (1, 4, "vulnerability", "cve-2024-1", ["target-sector: finance "]),
        (1, 5, "text", "S0001: Tool", ["sector:energy"]),
        (1, 6, "text", "T1059: Name", ["sector:energy"]),
        (1, 7, "url", "  ", ["malware-type:Evil"]),
        (1, 8, "url", None, ["malware-type:Evil"]),
        (1, 9, "url", "http://x", []),
        (1, 10, "url", "http://x", None),
    ]
    got = {(r["seq"], r["rel_type"], str(r["from_key"]), str(r["to_key"]), r["confidence"]) for r in D.embedded(frame(rows, "event_id long, idx int, attr_type string, value string, tags array<string>")).collect()}
    ip = str({"value": "10.0.0.1", "indicator_type": "ipv4"})
    assert got == {
        (1001, "INDICATES", ip, "{'name': 'Evil'}", 0.3), (1001, "INDICATES", ip, "{'name': 'Other'}", 0.3), (1001, "EXPLOITS", ip, "{'cve_id': 'CVE-2024-1'}", 0.7), (1001, "TARGETS", ip, "{'name': 'energy'}", 0.3),
        (1002, "EMPLOYS_TECHNIQUE", "{'name': 'Bear'}", "{'mitre_id': 'T1059'}", 0.5), (1003, "ATTRIBUTED_TO", "{'name': 'Evil'}", "{'name': 'Bear'}", 0.5),
        (1004, "AFFECTS", "{'cve_id': 'CVE-2024-1'}", "{'name': 'finance'}", 0.5), (1005, "TARGETS", "{'mitre_id': 'S0001'}", "{'name': 'energy'}", 0.5),
    }


NODES = "label string, id string, kind string, key string, aliases array<string>"


def test_dispatch_edges_and_drops(spark, frame):
    nodes = [
        ("Indicator", "i1", "domain", "Host.Example", None), ("Indicator", "i2", "hostname", "host.example", None), ("Indicator", "i3", "url", "http://X", None),
        ("Malware", "m1", None, "Evil", ["Bad ", "unknown"]), ("Malware", "m2", None, "bad", None), ("ThreatActor", "a1", None, "Bear", ["unknown", "APT 1"]),
        ("Vulnerability", "v1", None, "CVE-2024-1", None), ("CVE", "c1", None, "cve-2024-1", None), ("Tool", "t1", None, "S0001", None), ("Technique", "q1", None, "T1", None),
    ]
    d = [
        ("INDICATES", "Indicator", {"value": "HOST.example", "indicator_type": "domain"}, "Malware", {"name": " BAD"}, 0.4, "x", "1", 5),
        ("INDICATES", "Indicator", {"value": "host.example", "indicator_type": "domain"}, "Malware", {"name": "bad"}, 0.9, "y", "2", 4),
        ("INDICATES", "Indicator", {"value": "http://x", "indicator_type": "url"}, "Malware", {"name": "bad"}, 0.9, "y", "2", 4),
        ("INDICATES", "Indicator", {"value": "host.example", "indicator_type": "domain"}, "Vulnerability", {"cve_id": "CVE-2024-1"}, 0.9, "y", "2", 4),
        ("EXPLOITS", None, {"value": "http://X"}, None, {"cve_id": "cve-2024-1 "}, None, None, None, 1),
        ("AFFECTS", "Vulnerability", {"cve_id": "CVE-2024-1"}, "Sector", {"name": "Energy"}, 0.5, "x", "", 1),
        ("AFFECTS", "Vulnerability", {"cve_id": "CVE-2024-1"}, "Sector", {"name": " "}, 0.5, "x", "1", 1),
        ("ATTRIBUTED_TO", "Malware", {"name": "evil"}, "ThreatActor", {"name": "apt 1"}, 0.5, "x", "1", 1),
        ("ATTRIBUTED_TO", "Malware", {"name": "evil"}, "ThreatActor", {"name": "unknown"}, 0.5, "x", "1", 1),
        ("IMPLEMENTS_TECHNIQUE", "Tool", {"mitre_id": "s0001"}, "Technique", {"mitre_id": "T1"}, 0.5, "x", "1", 1),
        ("IMPLEMENTS_TECHNIQUE", None, {"name": "evil"}, "Technique", {"mitre_id": "T1"}, 0.5, "x", "1", 1),
        (None, None, None, None, None, None, None, None, None),
    ]
    out = D.Dispatch(frame(d, D.DEFINITION), D.endpoint_index(frame(nodes, NODES)))
    edges = {(r["type"], r["src"], r["trg"], r["confidence"], tuple(r["sources"])) for r in out.edges.collect()}
    hosts = {("INDICATES", i, m, 0.4, ("x", "y")) for i in ("i1", "i2") for m in ("m1", "m2")}
    assert edges == hosts | {("EXPLOITS", "i3", "v1", 0.5, ()), ("EXPLOITS", "i3", "c1", 0.5, ()), ("AFFECTS", "v1", "Sector:energy", 0.5, ("x",)), ("AFFECTS", "c1", "Sector:energy", 0.5, ("x",)),
                             ("ATTRIBUTED_TO", "m1", "a1", 0.5, ("x",)), ("IMPLEMENTS_TECHNIQUE", "t1", "q1", 0.5, ("x",))}
    assert out.members.where("src = 'i1' AND trg = 'm1'").count() == 2 and out.members.where("type = 'AFFECTS'").count() == 0
    assert [r["id"] for r in out.sectors.collect()] == ["Sector:energy"]
    report = {r["grp"]: (r["definitions"], r["dropped"], r["unresolved"], r["edges"], r["most"]) for r in out.report.collect()}
    assert report["INDICATES_malware"] == (3, 0, 1, 4, 4) and report["AFFECTS_cve"] == (2, 1, 0, 1, 1) and report["ATTRIBUTED_TO"] == (2, 0, 1, 1, 1)
    assert report["no route: IMPLEMENTS_TECHNIQUE"] == (1, 1, 0, 0, 0) and report["no route: "] == (1, 1, 0, 0, 0) and report["no route: INDICATES"] == (1, 1, 0, 0, 0)


def test_dispatch_of_nothing(frame):
    out = D.Dispatch(frame([], D.DEFINITION), D.endpoint_index(frame([], NODES)))
    assert out.edges.collect() == [] and out.members.collect() == [] and out.report.collect() == []


def test_dispatch_moves_definitions_once(frame):
    """A definition is held against its own type's routes only, a key is stripped once, and members shuffle definitions for their last distinct alone."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    d = frame([("EXPLOITS", None, {"value": "x"}, None, {"cve_id": "cve-2024-1"}, 0.5, "x", "1", 1)], D.DEFINITION)
    routed = plan(D.routed(d))
    assert routed.count("regexp_replace") == 6 and "lambda x" in routed and "= rel_type" not in routed
    assert plan(D.Dispatch(d, D.endpoint_index(frame([], NODES))).members).count("Exchange hashpartitioning") == 1


def test_direct_claims_give_the_same_table_without_a_copy(spark, frame, monkeypatch):
    from sigilgraph.operators import store

    rules = Rules(["k"], "at", highest=["c"], last=["v"], sets=["s"], counts=["n"])
    kind = "k string, at long, c double, v string, s array<string>, n int"
    batches = [frame([("a", 1, 0.5, "x", ["p"], 1), ("b", 2, 0.1, None, ["q"], 1), ("a", 3, 0.2, "y", ["q"], 1), (None, 4, 1.0, "z", [], 1)], kind), frame([("a", 2, 0.9, "w", ["r"], 1), ("c", 1, 0.3, "u", [], 1)], kind)]
    tables = [KeyedTable(spark, scratch_path(spark, "t"), rules, buckets=2) for _ in range(2)]
    told = [tables[0].upsert(b) for b in batches]
    monkeypatch.setattr(store, "materialize", None)  # no copy of the claims is written
    assert [tables[1].upsert(b, direct=True) for b in batches] == told
    rows = [sorted(map(tuple, t.read().collect()), key=str) for t in tables]
    assert rows[0] == rows[1] and len(rows[0]) == 3
    assert [(w.asked, w.touched, w.inserted) for w in told] == [(3, 2, 2), (2, 2, 1)]


def test_a_domain_table_that_is_written_is_read_by_those_made_of_it(spark):
    from sigilgraph.plans import catalog

    t = catalog.Tables(spark, "/root/testdata/sf0.001")
    t.written("attribute", ["indicator_id", "malware_id"])
    assert "l_orderkey" not in t.indicates._jdf.queryExecution().optimizedPlan().toString()


def test_alert_messages_are_packed(spark):
    import glob

    from sigilgraph.plans import alerting, catalog

    store = alerting._runs(catalog.Tables(spark, "/root/testdata/sf0.001"))
    files = glob.glob(f"{store.path.removeprefix('file://').removesuffix('/store')}/in/part-*")
    assert files and all(f.endswith(".gz") for f in files)
    assert store.alerts.read().count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
