"""STIX bundles: files, depths, twins, aliases, missing values and staging events."""

import hashlib
import json
import uuid
from datetime import datetime

from pyspark.sql import functions as F

from sigilgraph.functions.ident import NAMESPACE
from sigilgraph.operators import bundles as B
from sigilgraph.session import scratch_path

NODES = "label string, key string, managed boolean, name string, aliases array<string>, mitre_id string, cve_id string, indicator_type string, value string, description string"
EDGES = "type string, src_label string, src_key string, trg_label string, trg_key string"

def now():
    return F.lit("2024-06-01 12:00:00").cast("timestamp")


CLAIMS = "label string, key string, first timestamp, last timestamp"


def node(label, key, managed=True, **more):
    return tuple({"label": label, "key": key, "managed": managed, **more}.get(f.split()[0]) for f in NODES.split(", "))


def ident(kind, key):
    return f"{kind}--{uuid.uuid5(uuid.UUID(NAMESPACE), f'{kind}:{key}'.lower())}"


def graph(frame):
    nodes = [
        node("ThreatActor", "a1", name="Bear", aliases=["Fancy", "unknown"]), node("ThreatActor", "a2", name="Other", aliases=["FANCY"]), node("ThreatActor", "a3", False, name="Hidden"),
        node("Malware", "m1", name="Bot"), node("Malware", "m2", False, name="Gone"), node("Technique", "t1", mitre_id="T1.2"), node("Technique", "t2", mitre_id="T2"), node("Campaign", "c1", name="Bear Campaign"), node("Tool", "o1", name="Tool"),
        node("Vulnerability", "v1", cve_id="CVE-1", description="v"), node("CVE", "v1", cve_id="CVE-1", description="c"), node("CVE", "v2", cve_id="CVE-2"), node("Vulnerability", "v2", False, cve_id="CVE-2"),
        node("Indicator", "i1", indicator_type="domain", value="x'y\\z"), node("Indicator", "i2", indicator_type="odd", value="q"), node("Sector", "s1", name="energy"), node("Odd", "z"),
    ]
    edges = [
        ("ATTRIBUTED_TO", "Malware", "m1", "ThreatActor", "a1"), ("ATTRIBUTED_TO", "Malware", "m1", "ThreatActor", "a1"), ("ATTRIBUTED_TO", "Malware", "m2", "ThreatActor", "a1"), ("EMPLOYS_TECHNIQUE", "ThreatActor", "a1", "Technique", "t1"),
        ("IMPLEMENTS_TECHNIQUE", "Malware", "m1", "Technique", "t2"), ("IMPLEMENTS_TECHNIQUE", "Malware", "m2", "Technique", "t2"), ("IMPLEMENTS_TECHNIQUE", "Tool", "o1", "Technique", "t2"), ("RUNS", "ThreatActor", "a1", "Campaign", "c1"), ("USES_TECHNIQUE", "Indicator", "i1", "Technique", "t2"),
        ("EXPLOITS", "Indicator", "i1", "Vulnerability", "v1"), ("EXPLOITS", "Indicator", "i1", "CVE", "v1"), ("EXPLOITS", "Indicator", "i2", "CVE", "v2"), ("AFFECTS", "CVE", "v1", "Sector", "s1"), ("INDICATES", "Indicator", "i1", "Malware", "m1"), ("INDICATES", "Indicator", "i1", "Malware", "nowhere"), ("TARGETS", "Indicator", "i1", "Sector", "s1"),
    ]
    day = datetime(2024, 1, 2, 3, 4, 5)
    return frame(nodes, NODES), frame(edges, EDGES), frame([("Malware", "m1", day, day), ("Malware", "m1", datetime(2023, 1, 1), None), ("Sector", "s1", day, day)], CLAIMS)


def held(rows):
    out = {}
    for r in rows.collect():
        o = json.loads(r["object"])
        assert o["id"] == r["id"]
        out.setdefault(r["seed"], {})[r["id"]] = o
    return out


def told(objects):
    """Objects in short: types and names, and relations by their ends."""
    by = {i: f"{o['type']}:{o.get('name')}" for i, o in objects.items()}
    return {by[i] for i, o in objects.items() if o["type"] != "relationship"} | {(o["relationship_type"], by[o["source_ref"]], by[o["target_ref"]]) for o in objects.values() if o["type"] == "relationship"}


def test_actor_bundle_and_depths(spark, frame):
    g = graph(frame)
    two, one = (held(B.export(*g, "ThreatActor", now(), d)) for d in (2, 1))
    bear, bot = "intrusion-set:Bear", "malware:Bot"
    assert told(one["Bear"]) == {bear, bot, ("attributed-to", bot, bear)}
    assert told(two["Bear"]) == {bear, bot, "attack-pattern:T1.2", "attack-pattern:T2", "campaign:Bear Campaign", ("attributed-to", bot, bear), ("uses", bear, "attack-pattern:T1.2"), ("uses", bot, "attack-pattern:T2"), ("attributed-to", "campaign:Bear Campaign", bear)}
    assert set(two) == {"Bear", "Other"} and told(two["Other"]) == {"intrusion-set:Other"}
    m = two["Bear"][ident("malware", "Bot")]
    assert m["x_kg_first_seen_at_source"] == "2023-01-01T00:00:00+00:00" and m["x_kg_last_seen_at_source"] == "2024-01-02T03:04:05+00:00" and m["malware_types"] == ["unknown"] and not m["is_family"]
    t = two["Bear"][ident("attack-pattern", "T1.2")]
    assert t["external_references"][0]["url"].endswith("/techniques/T1/2") and t["created"] == "2024-06-01T12:00:00.000Z" and "kill_chain_phases" not in t
    s, r = ident("malware", "Bot"), ident("intrusion-set", "Bear")
    assert ident("relationship", f"{s}|attributed-to|{r}") in two["Bear"]


def test_actors_by_alias(spark, frame):
    g = graph(frame)
    asked = frame([("fancy ",), ("OTHER",), ("unknown",), ("nobody",), (None,), ("Hidden",)], "asked string")
    got = held(B.export(*g, "ThreatActor", now(), 2, asked))
    assert {s: next(o["name"] for o in v.values() if o["type"] == "intrusion-set") for s, v in got.items()} == {"fancy ": "Bear", "OTHER": "Other"}


def test_twins_and_other_labels(spark, frame):
    g = graph(frame)
    v = held(B.export(*g, "Vulnerability", now()))
    assert told(v["CVE-1"]) == {"vulnerability:CVE-1", "indicator:domain:x'y\\z", ("indicates", "indicator:domain:x'y\\z", "vulnerability:CVE-1")}
    assert v["CVE-1"][ident("vulnerability", "CVE-1")]["description"] == "v"
    assert told(v["CVE-2"]) == {"vulnerability:CVE-2", "indicator:odd:q", ("indicates", "indicator:odd:q", "vulnerability:CVE-2")}
    i = held(B.export(*g, "Indicator", now()))["x'y\\z"]
    assert {k for k in told(i) if isinstance(k, tuple)} == {("indicates", "indicator:domain:x'y\\z", x) for x in ("malware:Bot", "vulnerability:CVE-1", "attack-pattern:T2")} | {("targets", "indicator:domain:x'y\\z", "identity:energy")}
    own = next(o for o in i.values() if o["type"] == "indicator")
    assert own["pattern"] == "[domain-name:value = 'x\\'y\\\\z']" and own["x_kg_first_seen_inferred"] is True
    odd = held(B.export(*g, "Indicator", now()))["q"]
    assert next(o for o in odd.values() if o["type"] == "indicator")["pattern"] == "[artifact:payload_bin = 'q']"
    assert "x_kg_first_seen_at_source" not in next(o for o in i.values() if o["type"] == "identity")
    t = held(B.export(*g, "Technique", now()))["T2"]
    assert {k for k in told(t) if isinstance(k, tuple)} == {("uses", "malware:Bot", "attack-pattern:T2"), ("uses", "tool:Tool", "attack-pattern:T2"), ("indicates", "indicator:domain:x'y\\z", "attack-pattern:T2")}


def test_files_are_bundles_line_by_line(spark, frame):
    rows = B.export(*graph(frame), "ThreatActor", now())
    paths = [scratch_path(spark, "bundles") for _ in range(2)]
    B.write_bundles(rows, paths[0], "here")
    B.write_bundles(rows.repartition(7), paths[1], "here")
    texts = []
    for p in paths:
        files = sorted(f["name"] for f in spark.read.format("binaryFile").load(p).select(F.col("path").alias("name")).collect())
        texts.append("".join(bytes(spark.read.format("binaryFile").load(f).first()["content"]).decode() for f in files))
    assert texts[0] == texts[1]
    found = [json.loads(x + "]}") for x in texts[0].split("\n]}\n") if x]
    assert len(found) == 2
    for b in found:
        ids = [o["id"] for o in b["objects"]]
        name = hashlib.sha256(json.dumps(ids, separators=(",", ":")).encode()).hexdigest()
        assert ids == sorted(ids) and b["id"] == f"bundle--{uuid.uuid5(uuid.UUID(NAMESPACE), name)}" and b["x_kg_source"]["producer"] == "here"
    told_ids = {r["seed"]: (r["n_objects"], r["bundle_id"]) for r in B.bundle_ids(rows).collect()}
    assert sorted(told_ids.values()) == sorted((len(b["objects"]), b["id"]) for b in found)


def test_a_seed_with_many_neighbours(spark):
    """60,000 indicators of one technique: its rows stay rows."""
    i = spark.range(60_000).select(F.lit("Indicator").alias("label"), F.col("id").cast("string").alias("key"), F.lit(True).alias("managed"), F.lit("ipv4").alias("indicator_type"), F.col("id").cast("string").alias("value"), F.lit(None).cast("string").alias("mitre_id"))
    nodes = i.unionByName(spark.range(1).select(F.lit("Technique").alias("label"), F.lit("T1").alias("key"), F.lit(True).alias("managed"), F.lit(None).cast("string").alias("indicator_type"), F.lit(None).cast("string").alias("value"), F.lit("T1").alias("mitre_id")))
    edges = i.select(F.lit("USES_TECHNIQUE").alias("type"), F.lit("Indicator").alias("src_label"), F.col("key").alias("src_key"), F.lit("Technique").alias("trg_label"), F.lit("T1").alias("trg_key"))
    rows = B.export(nodes, edges, spark.createDataFrame([], CLAIMS), "Technique", now())
    r = B.bundle_ids(rows).collect()
    assert [x["n_objects"] for x in r] == [120_001]


def test_empty_graph(spark, frame):
    rows = B.export(frame([], NODES), frame([], EDGES), frame([], CLAIMS), "ThreatActor", now())
    assert rows.collect() == [] and B.bundle_ids(rows).collect() == []
    B.write_bundles(rows, scratch_path(spark, "bundles"), "here")


EVENTS = "id string, uuid string, info string, tags array<string>, attributes array<struct<uuid: string, type: string, value: string, comment: string, tags: array<string>, first_seen: timestamp, last_seen: timestamp, timestamp: timestamp>>"


def test_event_objects(spark, frame):
    day = datetime(2024, 1, 2)
    a = [("1", "sha256", "ab", None, ["zone:Finance", "zone:nowhere"], day, None, None), ("2", "text", "TA0001: Impact", "said", None, None, None, day), ("3", "text", "T12: x", None, [], None, None, None), ("4", "url", "", None, [], None, None, None), ("5", "regkey", "x", None, [], None, None, None),
         ("6", "url", None, None, [], None, None, None), ("7", "text", "S0001: T", "MITRE_USES_TECHNIQUES:{broken", [], None, None, None), ("8", None, "x", None, [], None, None, None)]
    rows = frame([("9", "e", "feed", ["sector:global"], a), ("10", "f", None, None, None)], EVENTS)
    got = {}
    for r in B.event_objects(rows, now()).orderBy("event_id", "place").collect():
        got.setdefault(r["event_id"], []).append(json.loads(r["object"]))
    report, file, tactic, tool = got["9"]
    assert report["object_refs"] == ["file--1", "x-mitre-tactic--2", "tool--7"] and report["labels"] == ["zone:global"]
    assert file["hashes"] == {"SHA256": "ab"} and file["x_kg_zones"] == ["zone:finance"] and file["x_kg_first_seen_at_source"] == "2024-01-02T00:00:00+00:00" and "created" not in file
    assert tactic["name"] == "Impact" and tactic["labels"] == ["zone:global"] and tactic["external_references"][0]["external_id"] == "TA0001"
    assert tool["description"] == "MITRE_USES_TECHNIQUES:{broken" and "x_kg_uses_techniques" not in tool
    assert got["10"][0]["object_refs"] == [] and got["10"][0]["name"] == "Event" and len(got["10"]) == 1


def test_bundle_ids_of_depths_in_one_pass(frame):
    g = graph(frame)
    for label in ("ThreatActor", "Vulnerability", "Indicator", "Technique"):
        got = {(r.depth, r.seed): (r.n_objects, r.bundle_id) for r in B.bundle_ids(B.export_ids(*g[:2], label), [1, 2]).collect()}
        one_by_one = {(d, r.seed): (r.n_objects, r.bundle_id) for d in (1, 2) for r in B.bundle_ids(B.export(*g, label, now(), d)).collect()}
        assert got == one_by_one and got


def test_nodes_are_not_broadcast(frame):
    plan = B.export_ids(*graph(frame)[:2], "Indicator")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [label" not in plan


def test_an_object_has_two_texts_to_normalise(frame):
    plan = B.objects(B.with_source_times(B._filled(graph(frame)[0]), graph(frame)[2]), now())._jdf.queryExecution().optimizedPlan().toString()
    assert sum("ArrowEvalPython" in line for line in plan.splitlines()) <= 2
