"""Identity, clamps, time, tags and zones against known vectors."""

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sigilgraph.functions import ident, scalars, tags, zones


def one(frame, value, expr, kind="string"):
    return frame([(value,)], f"v {kind}").select(expr(F.col("v"))).first()[0]


def test_known_uuid(frame):
    row = frame([("ipv4", "203.0.113.5")], "t string, v string")
    got = row.select(ident.node_uuid("Indicator", [F.col("t"), F.col("v")])).first()[0]
    assert got == "6ca3af4a-4bf1-57c9-846d-ec8f80861fd0"


@pytest.mark.parametrize("name", ["APT28", " apt28 ", "Café", "a|b", "", None, "\tx\n"])
def test_uuid_equals_python(frame, name):
    text = (name or "").strip().replace("|", "%7C")
    want = uuid.uuid5(uuid.UUID(ident.NAMESPACE), f"malware:{text}".lower() if text else "__missing__:malware")
    assert one(frame, name, lambda c: ident.node_uuid("Malware", [c])) == str(want)


def test_unicode_forms_agree(frame):
    rows = frame([("Café",), ("Café",)], "v string")
    assert rows.select(ident.node_uuid("Malware", [F.col("v")], unicode=True)).distinct().count() == 1


@pytest.mark.parametrize("name,bad", [("Unknown", True), (" n/a ", True), ("un​known", True), (None, True), ("", True), ("TrickBot", False)])
def test_placeholders(frame, name, bad):
    assert one(frame, name, ident.is_placeholder) is bad


def test_merge_value_case(frame):
    rows = frame([("ipv4", "A"), ("url", "A"), ("sha256", "AB "), ("email", "A@b")], "t string, v string")
    assert [r[0] for r in rows.select(ident.merge_value(F.col("t"), F.col("v"))).collect()] == ["a", "A", "ab", "A@b"]


@pytest.mark.parametrize("v,want", [("NaN", None), ("1e309", None), ("-1", None), ("10", 10.0), ("0", 0.0), ("x", None), (None, None), ("10.1", None)])
def test_cvss_clamp(frame, v, want):
    assert one(frame, v, scalars.clamp_cvss) == want
    assert one(frame, v, scalars.clamp_confidence) == (0.0 if v == "0" else 0.5)


@pytest.mark.parametrize("v,want", [("2024-01-02", datetime(2024, 1, 2)), ("2024-01-02T03:04:05Z", datetime(2024, 1, 2, 3, 4, 5)), ("2024-01-02T03:04:05+02:00", datetime(2024, 1, 2, 1, 4, 5)), ("0", None), ("1", datetime(1970, 1, 1, 0, 0, 1)), ("253402300800", None), ("2024-13-01", None), ("soon", None), (None, None)])
def test_iso_time(frame, v, want):
    got = one(frame, v, lambda c: F.date_format(scalars.iso_time(c), "yyyy-MM-dd HH:mm:ss"))
    assert got == (want and want.strftime("%Y-%m-%d %H:%M:%S"))


def test_event_tiers(frame):
    rows = frame([(n,) for n in (10, 11, 20, 21, 100, 101, 500, 501)], "n int")
    assert [r[0] for r in rows.select(scalars.event_tier(F.col("n"))).collect()] == [0.5, 0.45, 0.45, 0.4, 0.4, 0.35, 0.35, 0.3]


def test_decay_tiers(frame):
    rows = frame([(n,) for n in (89, 90, 179, 180, 364, 365, 366)], "n int")
    got = [tuple(r) for r in rows.select(scalars.decay_tier(F.col("n")), scalars.decayed("Indicator", F.lit(0.5), F.col("n"))).collect()]
    assert got == [(None, 0.5), ("90-180", 0.43), ("90-180", 0.43), ("180-365", 0.35), ("180-365", 0.35), (None, 0.5), ("retired", 0.5)]


@pytest.mark.parametrize("v,want", [(["global", "energy"], ["energy"]), (["global"], ["global"]), (["finance", "energy"], ["energy", "finance"])])
def test_zone_fold(frame, v, want):
    assert one(frame, v, scalars.zone_fold, "array<string>") == want


@pytest.mark.parametrize("v,want", [(["source:NVD"], "nvd"), (["x", "source:what", "NVD"], "misp"), (["ThreatFox", "source:NVD"], "threatfox"), ([], "misp")])
def test_source_of(frame, v, want):
    assert one(frame, v, tags.source_of, "array<string>") == want


def test_tag_extraction(frame):
    v = ['misp-galaxy:mitre-attack-pattern="PowerShell - T1059.001"', "mitre-attack:technique:T1001", "target-sector: Energy ", "exploits:cve-2024-9", "exploits:x", 'misp-galaxy:malware="Trick Bot"']
    assert one(frame, v, tags.techniques_of, "array<string>") == ["T1059.001", "T1001"]
    assert one(frame, v, tags.sector_of, "array<string>") == "energy"
    assert one(frame, v, tags.exploits_of, "array<string>") == ["CVE-2024-9"]
    assert one(frame, v, tags.malware_of, "array<string>") == ["Trick Bot"]


def test_meta(frame):
    good = 'NVD_META:{"cvss_v31_data": {"base_score": 11}, "cvss_v2_data": {"base_score": 5.5}}'
    assert one(frame, good, lambda c: tags.meta_score(tags.meta_json(c, "NVD_META:"))) == 5.5
    assert one(frame, "NVD_META:{bad", lambda c: tags.meta_json(c, "NVD_META:")) is None


@pytest.mark.parametrize("v,want", [("10.0.0.256", "domain"), ("10.0.0.1", "ip-dst"), ("a" * 32, "md5"), ("CVE-2024-1", "vulnerability"), ("a@b.c", "email-src"), ("word", "text")])
def test_infer_type(frame, v, want):
    assert one(frame, v, scalars.infer_type) == want


@pytest.mark.parametrize("v", ["a'b", "c\\d", "plain", "\\'"])
def test_pattern_round_trip(frame, v):
    assert one(frame, v, lambda c: scalars.pattern_value(scalars.stix_pattern(F.lit("url"), c))) == v


@pytest.mark.parametrize("text,want", [("A hospital breach", ["healthcare"]), ("SCADA and a power grid; banking trojan", ["energy", "finance"]), ("nothing here", ["global"]), ("non-medical hospital", ["global"]), (None, ["global"])])
def test_zone_detection(frame, text, want):
    assert zones.detect_zones(frame([(text,)], "t string"), "t").first()["zones"] == want


def test_item_zones(frame):
    rows = frame([("Hospital hit", "a bank, banking and a hospital"), ("x", "y")], "title string, body string")
    got = [r["zones"] for r in zones.detect_item_zones(rows, {"title": "title", "body": "description"}).collect()]
    assert got == [["healthcare", "finance"], ["global"]] or got == [["healthcare"], ["global"]]
