"""Change sets, cursors, phrases, containment and alerts: edge cases and plain Python."""

import json
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sigilgraph.functions import zones as Z
from sigilgraph.operators import changes as C
from sigilgraph.operators import link as L
from sigilgraph.operators.store import KeyedTable, Rules
from sigilgraph.session import scratch_path
from sigilgraph.sources import cursor as K
from sigilgraph.streaming import enrichment as E


def test_diff_and_apply(frame):
    schema = "k string, j long, a double, b string"
    wanted = frame([("x", 1, 1.0, None), ("x", 2, None, "b"), ("y", 1, 2.0, "c"), (None, 1, 1.0, "n")], schema)
    stored = frame([("x", 1, None, "1.0"), ("x", 2, None, "b"), ("z", 9, 1.0, "d")], schema)
    d = C.diff(wanted, stored, ["k", "j"], ["a", "b"])
    assert {(r["k"], r["j"], r["a"], r["b"], r["op"]) for r in d.collect()} == {("x", 1, 1.0, None, "update"), ("y", 1, 2.0, "c", "insert"), ("z", 9, None, None, "delete")}
    assert {(r["k"], r["j"], r["a"], r["b"]) for r in C.applied(stored, d, ["k", "j"], ["a", "b"]).collect()} == {("x", 1, 1.0, None), ("x", 2, None, "b"), ("y", 1, 2.0, "c")}
    assert {r["op"] for r in C.diff(wanted, stored, ["k", "j"], prune=False).collect()} == {"insert"}
    assert C.diff(wanted.limit(0), stored.limit(0), ["k"]).collect() == []


def test_activity_changes(frame):
    nodes = frame([(1, True, None), (2, False, None), (3, None, None), (4, True, datetime(2024, 1, 1)), (5, True, None)], "k long, active boolean, retired_at timestamp")
    events = frame([(1, "a"), (2, "b"), (2, "a"), (3, "a"), (4, "a")], "k long, event_id string")
    got = {(r["k"], r["active"]) for r in C.activity_changes(nodes, events, frame([("b",), ("b",)], "event_id string"), "k").collect()}
    assert got == {(1, False), (2, True), (3, False)}
    assert C.activity_changes(nodes, events, frame([], "event_id string"), "k").collect() == []


def test_campaign_links_of_a_hot_campaign(spark, frame):
    """One actor has nearly all indicators; the cut is by time, then value."""
    ind = spark.range(0, 20_000, 1, 8).select(F.col("id").alias("indicator"), F.col("id").cast("string").alias("value"), (F.col("id") % 5 > 0).alias("active"), F.timestamp_seconds(F.col("id") % 7).alias("first_seen"))
    pairs = ind.select("indicator", F.lit("m").alias("malware"))
    links = C.campaign_links(frame([("m", "a"), ("m", "a"), ("n", "b")], "malware string, actor string"), pairs.unionByName(pairs), ind, 3).collect()
    own = sorted(((i % 7, str(i)) for i in range(20_000) if i % 5), key=lambda x: (-x[0], x[1]))[:3]
    assert {(r["campaign"], r["member"]) for r in links if r["label"] == "Indicator"} == {("a Campaign", v) for _, v in own}
    assert {(r["campaign"], r["member"]) for r in links if r["label"] == "Malware"} == {("a Campaign", "m"), ("b Campaign", "n")}


def test_delta_needs_the_label(frame):
    schema = "uuid string, label string, a long"
    got = C.delta(frame([("u", "CVE", 1), ("u", "Vulnerability", 2), ("v", "CVE", None), (None, "CVE", 1)], schema), frame([("u", "CVE", 1), ("u", "Vulnerability", 3), ("w", "CVE", 1)], schema), ["uuid", "label"], ["a"])
    assert {(r["uuid"], r["label"]): r["status"] for r in got.collect()} == {("u", "CVE"): "same", ("u", "Vulnerability"): "changed", ("v", "CVE"): "only here", ("w", "CVE"): "only there"}


def test_runs_with_late_rows_give_what_one_run_gives(spark, frame):
    r = random.Random(2)
    day = datetime(2024, 1, 1)
    rows = [(k, day + timedelta(hours=r.randint(0, 200)), k % 7) for k in range(300)] + [(900, None, 1)]
    # What is late is so by no more than the overlap.
    batches = [[x for x in rows if x[1] and x[1] < day + timedelta(hours=100) and x[0] % 3], [x for x in rows if not (x[1] and x[1] < day + timedelta(hours=100) and x[0] % 3)]]
    ends = []
    for parts in (batches, [rows]):
        base = scratch_path(spark, "c")
        cursors, table = K.Cursors(spark, f"{base}/c"), KeyedTable(spark, f"{base}/t", Rules(["k"], "at", latest=["at"], last=["v"]), buckets=2)
        for p in parts:
            frame(p, "k long, at timestamp, v long").write.mode("append").parquet(f"{base}/in")
            K.sync(spark.read.parquet(f"{base}/in"), "s", "at", table, cursors, 100 * 3600)
        ends.append((sorted(str((x["k"], x["at"], x["v"])) for x in table.read().collect()), cursors.read("s")))
    assert ends[0] == ends[1] and len(ends[0][0]) == 301
    cursors.move("s", day, page=3, done=True)
    cursors.move("s", None, page=2)
    assert cursors.read("s") == {"cursor": max(x[1] for x in rows if x[1]), "page": 3, "done": 1} and cursors.read("other") is None
    again = K.sync(spark.read.parquet(f"{base}/in"), "s", "at", table, cursors, 0)
    assert again.changed == 0
    assert K.Cursors(spark, scratch_path(spark, "c")).read("s") is None


def test_phrases_equal_a_regex_for_each(spark, frame):
    r = random.Random(3)
    words = sorted({w for ws in Z.KEYWORDS.values() for p in ws for w in p.split()} | {w for ws in Z.EXCLUDING.values() for w in ws} | {"x-ray", "xray", "the", "_", "hospital_", "É", "-", "non", "medical", "ct-scan,"})
    texts = ["".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "-", ". ", "", "\n"]) for _ in range(r.randint(0, 60))) for _ in range(300)] + [None, "", " ", "Hospital", "HOSPITAL hospital", "smart grid operations"]
    rows = frame(list(enumerate(texts)), "k long, t string")
    got = {x["k"]: x["h"] for x in rows.select("k", Z.phrase_hits(F.col("t"), Z.KEYWORDS).alias("h")).collect()}
    for k, t in enumerate(texts):
        for zone, ws in Z.KEYWORDS.items():
            assert got[k][zone] == sum(len(re.findall(r"\b" + re.escape(w) + r"\b", (t or "").lower())) for w in dict.fromkeys(ws)), (t, zone)


@pytest.mark.parametrize("bad", ["a b a", "go go", " a", "a ", "", "-a"])
def test_phrases_that_are_none(frame, bad):
    with pytest.raises(ValueError):
        Z.phrase_hits(F.col("t"), {"z": [bad]})


@pytest.mark.parametrize("gram", [2, 6])
def test_contains_join(frame, gram):
    r = random.Random(gram)
    texts = ["".join(r.choice("ab:é") for _ in range(r.randint(0, 14))) for _ in range(120)] + [None, "", "ab"]
    parts = ["".join(r.choice("ab:é") for _ in range(r.randint(0, 9))) for _ in range(80)] + [None, "", "zzz", "a"]
    got = L.contains_join(frame(list(enumerate(parts)), "needle long, part string"), frame(list(enumerate(texts)), "text_id long, text string"), gram).collect()
    assert sorted((x["needle"], x["text_id"]) for x in got) == sorted((i, j) for i, p in enumerate(parts) for j, t in enumerate(texts) if p and t and p in t)


def context(frame):
    t = lambda d: datetime(2024, 1, d)
    return E.context(
        frame([("1.1.1.1", 0.4, ["energy"], t(3), t(4)), ("1.1.1.1", 0.7, ["finance"], t(2), None), ("host", 0.5, None, None, None)], "value string, confidence double, zones array<string>, first_imported_at timestamp, last_updated timestamp"),
        frame([("host", t(5), t(6)), ("host", t(1), None)], "value string, first timestamp, last timestamp"),
        frame([("1.1.1.1", "Bot"), ("1.1.1.1", "Bot"), ("1.1.1.1", "Worm")], "value string, malware string"),
        frame([("Bot", "f", "d"), ("Worm", None, None)], "malware string, family string, description string"),
        frame([("Bot", "Bear"), ("Worm", "Bear")], "malware string, actor string"), frame([("Bear", None)], "actor string, description string"),
        frame([("Bear", "T1")], "actor string, mitre_id string"), frame([("T1", "Name")], "mitre_id string, name string"), frame([("1.1.1.1", "CVE-1", 7.0, "HIGH")], "value string, cve_id string, score double, severity string"),
    )


def message(k, **threat):
    return (json.dumps({"alert_id": k, "source": "w", "zone": "health", "timestamp": "2024-02-01T00:00:00Z", "threat": threat}),)


def test_alert_answers(frame):
    raw = [message("a", indicator="1.1.1.1", type="ip", malware="Bot", cve="CVE-1", hostname="h", user="u", dest_ip="9"), message("b", indicator="new", type="odd", malware="Own", cve="CVE-9"), message("c", type="ip"), ("{broken",), ("{}",), (None,), message("d", indicator="host", type="domain"), ('{"alert_id":"e","threat":{"indicator":"host"},"tags":["x"]}',)]
    got = {r["alert_id"]: r for r in E.enrich(E.parse(frame(raw, "value string")), context(frame)).collect()}
    assert set(got) == {"a", "b", "c", "d", "e"}
    a = got["a"]
    assert a["indicator_found"] and a["confidence"] == 0.7 and a["first_seen"] == datetime(2024, 1, 2) and a["zones"] == ["energy", "finance"] and a["cross_zone"]
    assert [m["name"] for m in a["malware"]] == ["Bot", "Worm"] and [x["name"] for x in a["actors"]] == ["Bear"] and [x["mitre_id"] for x in a["techniques"]] == ["T1"] and [v["cve_id"] for v in a["cves"]] == ["CVE-1"]
    assert a["assets"][0]["hostname"] == "h" and a["users"][0].asDict() == {"username": "u", "domain": "default"}
    assert a["recommendations"] == ["Block IP 1.1.1.1 at perimeter firewall", "Isolate host h for forensic analysis", "Check h for persistence mechanisms", "Review activity for user 'u'", "Force password reset for user 'u'", "Deploy signatures for Bot", "Deploy signatures for Worm", "Apply patch for CVE-1", "Investigate outbound connections to 9", "Cross-zone threat detected - alert energy, finance teams"]
    b = got["b"]
    assert not b["indicator_found"] and b["confidence"] == 0 and [m["name"] for m in b["malware"]] == ["Own"] and [v["cve_id"] for v in b["cves"]] == ["CVE-9"] and b["zones"] == ["health"] and not b["cross_zone"]
    assert not got["c"]["enriched"] and got["c"]["error"] == "No indicator in alert" and got["c"]["recommendations"] == []
    assert got["d"]["first_seen"] == datetime(2024, 1, 1) and got["d"]["last_seen"] == datetime(2024, 1, 6)
    assert got["e"]["zones"] == ["global", "x"] and got["e"]["source"] == "unknown"


def test_alert_store_over_batches(spark, frame):
    store = E.AlertStore(spark, scratch_path(spark, "alerts"), 2)
    known = context(frame)
    batches = [[message("a", indicator="1.1.1.1", type="ip", severity=3), message("a", indicator="1.1.1.1", type="ip", severity=3), message("b", indicator="x", type="file_hash")], [message("a", indicator="1.1.1.1", type="ip", severity=3)], [], [message("c")]]
    for n, rows in enumerate(batches):
        for _ in range(2 if n == 1 else 1):  # one is replayed
            store.write(E.enrich(E.parse(frame(rows, "value string")), known), n)
    alerts = {r["alert_id"]: (r["severity"], r["enriched"]) for r in store.alerts.read().collect()}
    assert alerts == {"a": (3, True), "b": (None, True), "c": (None, False)} and store.alerts.read().count() == 3
    assert {(r["indicator_type"], r["value"], r["confidence"], tuple(r["zones"])) for r in store.indicators.read().collect()} == {("ipv4", "1.1.1.1", 0.8, ("health",)), ("hash", "x", 0.8, ("health",))}
    assert {(r["alert_id"], r["value"]) for r in store.involves.read().collect()} == {("a", "1.1.1.1"), ("b", "x")}


def test_tasks_and_broadcasts_are_bounded(spark):
    from sigilgraph.plans import catalog

    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20, "spark.sql.autoBroadcastJoinThreshold": 1 << 20}
    for key, most in keys.items():
        spark.conf.unset(key)
    catalog.queries()["R2_capped"](spark, "/root/testdata/sf0.001")
    assert {k: int(spark.conf.get(k)) for k in keys} == keys
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    catalog.queries()["R2_capped"](spark, "/root/testdata/sf0.001")
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
