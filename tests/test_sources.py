"""Feed readers, parsing, STIX and streams over small files."""

import json
from datetime import date

from pyspark.sql import functions as F

from sigilgraph.operators import enrich, link, merge, parse, stix
from sigilgraph.sources import feeds
from sigilgraph.streaming import alerts


def lines(tmp_path, name, rows):
    p = tmp_path / name
    p.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))
    return str(p)


def test_pulses(spark, tmp_path):
    path = lines(tmp_path, "p.json", [{"id": "1", "name": "n", "created": "2024-01-01", "adversary": " Bear ", "tags": ["a"], "malware_families": ["M1"], "indicators": [{"type": "IPv4", "indicator": "1.1.1.1"}, {"type": "CVE", "indicator": "cve-2024-1"}]}, {"id": "2", "adversary": ""}])
    got = sorted((r["kind"], r["value"]) for r in feeds.pulses(spark, path).collect())
    assert got == [("actor", "Bear"), ("indicator", "1.1.1.1"), ("malware", "M1"), ("vulnerability", "CVE-2024-1")]


def test_cve_feed(spark, tmp_path):
    path = lines(tmp_path, "c.json", [{"id": "cve-2024-1", "published": "2024-01-01T00:00:00", "v2": {"baseScore": 5.0}, "v31": {"baseScore": 9.8, "baseSeverity": "critical", "vectorString": "CVSS:3.1/AV:N/AC:L"}, "weaknesses": [["CWE-2", "CWE-1"], ["CWE-1"]], "cpes": ["cpe:2.3:a:vendor:product:1"] * 12}])
    r = feeds.cve_feed(spark, path).first()
    assert (r["value"], r["score"], r["severity"], r["attack_vector"], r["cwes"]) == ("CVE-2024-1", 9.8, "CRITICAL", "NETWORK", ["CWE-1", "CWE-2"])
    assert len(r["version_constraints"]) == 10 and r["products"][0].endswith("vendor product")


def test_windows():
    got = feeds.windows(date(2024, 1, 1), date(2024, 10, 1))
    assert got[0][1] == date(2024, 10, 1) and got[-1][0] == date(2024, 1, 1)
    assert all((b - a).days < 120 for a, b in got) and all((x[0] - y[1]).days == 1 for x, y in zip(got, got[1:]))


def test_small_feeds(spark, tmp_path):
    ioc = lines(tmp_path, "i.json", [{"ioc": "1.2.3.4:80", "ioc_type": "ip:port", "malware": "Bot", "confidence_level": 75}])
    r = feeds.ioc_feed(spark, ioc).first()
    assert (r["indicator_type"], r["value"], r["confidence"]) == ("ipv4", "1.2.3.4", 0.75)
    url = lines(tmp_path, "u.csv", ["# comment", '2,2024,"http://a",on,t,x', '1,2024,"http://a",off,t,y'])
    assert [(r["id"], r["value"]) for r in feeds.url_feed(spark, url).collect()] == [(1, "http://a")]
    h = lines(tmp_path, "h.txt", ["a" * 32, "b" * 40, "c" * 64, "not a hash!"])
    assert sorted(r["indicator_type"] for r in feeds.hash_lines(spark, h).collect()) == ["md5", "sha1", "sha256"]
    kev = lines(tmp_path, "k.json", [{"cveID": "cve-1", "dateAdded": "2024-01-01", "knownRansomwareCampaignUse": "Known"}])
    assert feeds.known_exploited(spark, kev).first()["score"] == 9.0
    ip = lines(tmp_path, "a.json", [{"ipAddress": "::1", "abuseConfidenceScore": 50, "reports": [{"categories": [5, 3]}, {"categories": [3]}]}])
    r = feeds.ip_reputation(spark, ip).first()
    assert (r["indicator_type"], r["confidence"], r["abuse_categories"]) == ("ipv6", 0.5, [3, 5])
    c2 = lines(tmp_path, "f.csv", ["# x", "2024-01-01 00:00:00,9.9.9.9,443,online,2024-01-02,Emotet"])
    assert feeds.blocklist(spark, c2).first()["malware"] == "emotet"
    tls = lines(tmp_path, "s.csv", ["# x", f"2024-01-01,{'AB' * 20},Bad"])
    assert feeds.certificates(spark, tls).first()["value"] == "ab" * 20
    att = lines(tmp_path, "m.json", [{"id": "a", "type": "intrusion-set", "name": "Bear"}, {"id": "t", "type": "attack-pattern", "mitre_id": "T1"}, {"type": "relationship", "relationship_type": "uses", "source_ref": "a", "target_ref": "t"}])
    assert feeds.attack_bundle(spark, att).first()["uses_techniques"] == ["T1"]


def test_parse_events(spark, tmp_path):
    tag = lambda *t: [{"name": x} for x in t]
    path = lines(tmp_path, "e.json", [{"id": "1", "info": "KG-nvd-2024", "tags": tag("zone:energy"), "attributes": [{"type": "ip-src", "value": " 1.1.1.1 ", "tags": tag("source:NVD", "confidence:high")}, {"type": "ip-dst", "value": "1.1.1.1", "tags": []}, {"type": "vulnerability", "value": "cve-2024-1", "comment": 'NVD_META:{"cvss_v31_data": {"base_score": 7.1}}', "tags": tag("cvss:low")}, {"type": "text", "value": "T1059", "tags": tag("zone:finance")}, {"type": "url", "value": "x" * 5000}, {"type": "url", "value": " "}]}])
    attrs = parse.explode_events(feeds.staging_events(spark, path))
    items = {r["key"]: r for r in parse.dedup_items(parse.parse_attributes(attrs)).collect()}
    assert set(items) == {"ipv4:1.1.1.1", "cve:CVE-2024-1", "technique:T1059"}
    assert (items["ipv4:1.1.1.1"]["source"], items["ipv4:1.1.1.1"]["confidence"], items["ipv4:1.1.1.1"]["zones"]) == ("nvd", 0.8, ["energy"])
    assert items["cve:CVE-2024-1"]["score"] == 7.1 and items["technique:T1059"]["zones"] == ["finance"]


def test_bundle_round_trip(spark, frame):
    rows = frame([("ipv4", "1.1.1.1")], "t string, v string").select(stix.indicator_object(F.col("t"), F.col("v"), F.lit("2024-01-01").cast("timestamp"), F.lit(0.5), F.array(F.lit("energy"))).alias("object"), stix.stix_id("Indicator", [F.col("t"), F.col("v")]).alias("id"))
    mal = frame([("Bot",)], "n string").select(stix.named_object("Malware", F.col("n")).alias("object"), stix.stix_id("Malware", [F.col("n")]).alias("id"))
    i, m = rows.first()["id"], mal.first()["id"]
    rel = frame([(i, m)], "a string, b string").select(stix.relation_object(F.lit("INDICATES"), F.col("a"), F.col("b")).alias("object"), stix.relation_id(F.lit("INDICATES"), F.col("a"), F.col("b")).alias("id"))
    every = rows.unionByName(mal).unionByName(rel).withColumn("g", F.lit(1))
    b = stix.bundles(every.unionByName(every), "g").first()
    assert b["n_objects"] == 3 and b["bundle_id"] == stix.bundles(every, "g").first()["bundle_id"]
    entities, relations = stix.read_bundle(frame([(json.dumps(o),) for o in json.loads(b["bundle"])["objects"]], "object string"))
    assert sorted((r["type"], r["name"] or r["value"]) for r in entities.collect()) == [("indicator", "1.1.1.1"), ("malware", "Bot")]
    assert [tuple(r) for r in relations.collect()] == [("indicates", "indicator", "1.1.1.1", "malware", "Bot")]


def test_alert_stream(spark, tmp_path):
    a = {"alert_id": "1", "source": "s", "zone": "z", "ts": "2024-01-01T00:00:00Z", "threat": {"indicator": "1.1.1.1", "malware": "Bot", "severity": 9}}
    (tmp_path / "in").mkdir()
    lines(tmp_path / "in", "a.txt", [a, a, "{broken", {**a, "alert_id": "2", "threat": {"indicator": "x", "cve": "CVE-1"}}])
    known = alerts.context(spark.createDataFrame([("1.1.1.1", 0.9)], "value string, confidence double"), spark.createDataFrame([("1.1.1.1", "Rat")], "value string, malware string"), spark.createDataFrame([("Rat", "Bear")], "malware string, actor string"), spark.createDataFrame([("1.1.1.1", None, None)], "value string, first timestamp, last timestamp"))
    stream = alerts.enrich(alerts.deduplicated(alerts.parse(spark.readStream.text(str(tmp_path / "in")))), known)
    out = str(tmp_path / "out")
    stream.writeStream.foreachBatch(alerts.replace_by_key(out, "alert_id")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    got = {r["alert_id"]: r for r in spark.read.parquet(out).collect()}
    assert got["1"]["malware"] == ["Bot", "Rat"] and got["1"]["actors"] == ["Bear"] and got["1"]["recommendations"] == ["isolate the host", "scan for malware"]
    assert got["2"]["recommendations"] == ["patch the vulnerability", "review by an analyst"]


def test_decay_once_for_each_tier(spark):
    day = lambda n: date.fromordinal(date(2024, 1, 1).toordinal() - n).isoformat()
    rows = spark.createDataFrame([(1, 0.5, True, None, day(100)), (2, 0.5, True, "90-180", day(100)), (3, 0.5, True, None, day(400)), (4, 0.11, True, None, day(200)), (5, 0.5, True, None, None)], "k int, confidence double, active boolean, last_decayed_tier string, d string").withColumn("seen", F.col("d").cast("timestamp"))
    out = enrich.decay(rows, "Indicator", "seen", F.lit("2024-01-01").cast("timestamp"))
    assert [(r["confidence"], r["active"]) for r in out.orderBy("k").collect()] == [(0.43, True), (0.5, True), (0.5, False), (0.1, True), (0.5, True)]


def test_merge_refuses_blank_keys_and_nan(frame):
    rows = frame([("a", 1, float("nan")), ("a", 2, 0.3), (" ", 3, 0.9), (None, 4, 0.9)], "k string, seq int, c double")
    assert [tuple(r) for r in merge.merge_nodes(rows, ["k"], "seq", highest=["c"]).collect()] == [("a", 0.3)]


def test_or_join_skips_placeholders(frame):
    m = frame([(1, " APT1 "), (2, "unknown"), (3, None)], "m int, by string")
    a = frame([(9, "apt1", ["x", "unknown"])], "a int, name string, aliases array<string>")
    out = link.or_join(m, a, [(link.names_of(F.col("by")), link.names_of(F.col("name"))), (link.names_of(F.col("by")), link.names_of(F.col("aliases"), lists=True))], [F.col("m"), F.col("a")])
    assert [tuple(r) for r in out.collect()] == [(1, 9)]


def test_or_join_shuffles_no_pairs(frame):
    m, a = frame([(n, "x" if n % 2 else "y") for n in range(40)], "m int, by string"), frame([(n, "x", ["y", "x"]) for n in range(30)], "a int, name string, aliases array<string>")
    out = link.or_join(m, a, [(F.col("by"), F.col("name")), (F.col("by"), F.explode("aliases"))], [F.col("m"), F.col("a").alias("of")])
    assert out.columns == ["m", "of"] and sorted(map(tuple, out.collect())) == [(x, y) for x in range(40) for y in range(30)]
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]


def test_an_empty_write_is_an_error():
    import pytest

    assert merge.effective(2, 3) == 2 and merge.effective(0, 0) == 0
    with pytest.raises(ValueError):
        merge.effective(0, 3)


def test_comment_data(frame):
    from sigilgraph.functions import tags

    rows = frame([('MITRE_USES_TECHNIQUES:{"t": ["T1"]}\ntext',), ("MITRE_USES_TECHNIQUES:[broken",), ("",), (None,)], "c string")
    assert [r[0] for r in rows.select(tags.meta_list(F.col("c"), "MITRE_USES_TECHNIQUES:", "t")).collect()] == [["T1"], [], [], []]
    named = frame([('x="A - B - T1234.001"',), ("T1234",), ("none",), (None,)], "t string").select(tags.galaxy_technique(F.col("t")).alias("g")).collect()
    assert [r["g"] and tuple(r["g"]) for r in named] == [("T1234.001", "A - B"), None, None, None]


def test_attack_relations_drop_unknown_ends(spark, tmp_path):
    things = [{"id": "m", "type": "malware", "name": "Bot"}, {"id": "a", "type": "intrusion-set", "name": "Bear"}, {"id": "t", "type": "attack-pattern", "name": "x", "mitre_id": "T1"}]
    rel = lambda k, s, t: {"type": "relationship", "relationship_type": k, "source_ref": s, "target_ref": t}
    path = lines(tmp_path, "r.json", [*things, rel("uses", "m", "t"), rel("attributed-to", "m", "a"), rel("attributed-to", "a", "m"), rel("subtechnique-of", "t", "t"), rel("uses", "m", "gone")])
    got = sorted((r["type"], r["source_name"], r["target_name"]) for r in feeds.attack_relations(spark, path).collect())
    assert got == [("attributed_to", "Bot", "Bear"), ("subtechnique_of", "x", "x"), ("uses", "Bot", "x")]
