"""Deterministic identity: canonical keys, placeholder names and version-5 UUIDs, in built-in functions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The identity namespace, STIX types of labels, natural keys, case rules and rejected names.
NAMESPACE = "5f2e1f9a-6a1b-5e0f-9b25-ed9ea2d574cb"
STIX_TYPES = {
    "Indicator": "indicator", "Malware": "malware", "ThreatActor": "intrusion-set", "Technique": "attack-pattern",
    "Tool": "tool", "Tactic": "x-mitre-tactic", "CVE": "vulnerability", "Vulnerability": "vulnerability",
    "Sector": "identity", "Campaign": "campaign", "CVSSv2": "x-kg-cvssv2", "CVSSv30": "x-kg-cvssv30",
    "CVSSv31": "x-kg-cvssv31", "CVSSv40": "x-kg-cvssv40", "Source": "x-kg-source", "User": "x-kg-user", "Alert": "x-kg-alert",
}
NATURAL_KEYS = {
    "Indicator": ["indicator_type", "value"], "Malware": ["name"], "ThreatActor": ["name"], "Sector": ["name"],
    "Campaign": ["name"], "Application": ["name"], "Technique": ["mitre_id"], "Tactic": ["mitre_id"], "Tool": ["mitre_id"],
    "CVE": ["cve_id"], "Vulnerability": ["cve_id"], "Source": ["source_id"], "IP": ["address"], "Host": ["hostname"],
    "Device": ["device_id"], "Subnet": ["range"], "NetworkService": ["port", "protocol"], "SoftwareVersion": ["version"],
    "Role": ["permission"], "User": ["username", "domain"], "Alert": ["alert_id"],
}
CASELESS_TYPES = ["ipv4", "ipv6", "domain", "hostname", "md5", "sha1", "sha256", "sha512", "ssdeep", "imphash", "ja3", "ja3s", "jarm", "mutex", "btc", "xmr", "eth"]
PLACEHOLDERS = [
    "", "unknown", "unknown malware", "unspecified", "undefined", "null", "none", "n/a", "na", "not applicable",
    "not available", "not specified", "tbd", "tbc", "todo", "fixme", "-", "--", "---", "..", "...", "?", "??", "generic",
    "test", "example", "malware", "trojan", "backdoor", "virus", "worm", "ransomware", "spyware", "adware", "rootkit",
    "actor", "threat", "threat actor", "attack", "attacker", "hacker", "apt", "apt group", "adversary",
]


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


@F.pandas_udf(T.StringType())
def _folded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v).casefold())


def _beyond_ascii(c: Column) -> Column:
    """The text if it has a character that normal forms could change, else NULL: only such texts are worth a Python worker's while."""
    return F.when(c.rlike(r"[^\x00-\x7F]"), c)


def nfc(c: Column) -> Column:
    """Normal form C. Spark has no function of its own for it, but brings ICU, which ``reflect`` calls in the JVM: Python workers for it would take
    memory of an executor for each task. ASCII texts are taken as they are."""
    composed = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), F.coalesce(c, F.lit("")), F.lit(False))
    return F.when(c.rlike(r"[^\x00-\x7F]"), composed).otherwise(c)


def folded(c: Column) -> Column:
    """NFKC and case folding, stripped: a name as people compare it."""
    return F.trim(F.coalesce(_folded(_beyond_ascii(c)), F.lower(c)))


def canon(c: Column, unicode: bool = True) -> Column:
    """A key field's canonical text: NULL as empty, in NFC (unless not ``unicode``, as inside lambdas), stripped, ``|`` escaped."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.replace(_strip(nfc(text) if unicode else text), F.lit("|"), F.lit("%7C"))


def natural_key(fields: list[Column], stix_type: str | Column, unicode: bool = True) -> Column:
    kind = F.lit(stix_type) if isinstance(stix_type, str) else stix_type
    joined = F.concat_ws("|", *[canon(f, unicode) for f in fields])
    empty = F.forall(F.array(*[canon(f, False) for f in fields]), lambda x: x == "")
    return F.when(empty, F.concat(F.lit("__missing__:"), kind)).otherwise(F.lower(F.concat(kind, F.lit(":"), joined)))


def uuid5(text: Column, namespace: str = NAMESPACE) -> Column:
    """RFC 4122 version-5 UUID of a text, from sha1 in the JVM. The hash stands in the expression once: the id of two ids would hash each of them six
    times as often as its own parts do."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(text, "UTF-8")))

    def laid_out(h: Column) -> Column:
        variant = F.substring(F.lit("89ab"), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
        part = lambda a, n: F.substring(h, a, n)
        return F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(variant, part(18, 3)), part(21, 12))

    return F.get(F.transform(F.array(digest), laid_out), F.lit(0))


def node_uuid(label: str, fields: list[Column], unicode: bool = True) -> Column:
    return uuid5(natural_key(fields, STIX_TYPES.get(label, "x-kg-" + label.lower()), unicode))


def merge_value(kind: Column, value: Column) -> Column:
    """An indicator's stored value: lowered for types without case."""
    v = _strip(value)
    return F.when(kind.isin(CASELESS_TYPES), F.lower(v)).otherwise(v)


def merge_name(name: Column) -> Column:
    return F.lower(_strip(name))


def is_placeholder(name: Column) -> Column:
    """True for NULL and for names that say nothing, also with zero-width signs inside."""
    bare = F.regexp_replace(name, "[​-‏‪-‮⁠-⁤﻿]", "")
    return F.coalesce(merge_name(bare).isin(PLACEHOLDERS), F.lit(True))
