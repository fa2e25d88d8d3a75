"""What tags of a staging attribute say, over array<string> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import lookup, zone_fold

# Source names and zones.
SOURCES = {
    "AlienVault-OTX": "alienvault_otx", "NVD": "nvd", "CISA-KEV": "cisa_kev", "MITRE-ATT&CK": "mitre_attck",
    "VirusTotal": "virustotal", "AbuseIPDB": "abuseipdb", "Feodo-Tracker": "feodo_tracker", "SSL-Blacklist": "ssl_blacklist",
    "URLhaus": "urlhaus", "CyberCure": "cybercure", "ThreatFox": "threatfox",
}
ZONES = ["global", "healthcare", "energy", "finance"]
TAG_SCORES = {"cvss:critical": 9.0, "cvss:high": 7.5, "cvss:medium": 5.5, "cvss:low": 3.0}
CONFIDENCE = {"confidence:high": 0.8, "confidence:medium": 0.5, "confidence:low": 0.3}


def _after(tag: Column, prefix: str) -> Column:
    return F.substring(tag, len(prefix) + 1, 1 << 30)


def source_of(tags: Column) -> Column:
    """The first ``source:`` tag or known bare name decides; an unknown ``source:`` and no tag are ``misp``."""
    told = F.filter(tags, lambda t: t.startswith("source:") | t.isin(list(SOURCES)))
    first = F.get(told, F.lit(0))
    name = F.when(first.startswith("source:"), _after(first, "source:")).otherwise(first)
    return lookup(SOURCES, name, "misp")


def zones_of(tags: Column) -> Column:
    """Zones named by ``zone:`` and ``sector:`` tags, sorted; ``global`` if none is known."""
    told = F.transform(F.filter(tags, lambda t: t.rlike("^(zone|sector):")), lambda t: F.lower(F.trim(F.regexp_replace(t, "^(zone|sector):", ""))))
    known = F.array_sort(F.array_distinct(F.filter(told, lambda z: z.isin(ZONES))))
    return F.when(F.size(known) > 0, known).otherwise(F.array(F.lit("global")))


def resolve_zones(own: Column, event: Column) -> Column:
    """An attribute's zones: its own specific ones, else those of both without ``global`` if any is specific."""
    specific = F.filter(own, lambda z: z != "global")
    both = F.coalesce(zone_fold(F.concat(own, event)), F.array())
    return F.when(F.size(specific) > 0, F.array_sort(specific)).when(F.size(both) > 0, both).otherwise(F.array(F.lit("global")))


def confidence_of(tags: Column) -> Column:
    """The last confidence tag; 0.5 without one."""
    last = F.try_element_at(F.filter(tags, lambda t: t.isin(list(CONFIDENCE))), F.lit(-1))
    return lookup(CONFIDENCE, last, 0.5)


def severity_of(tags: Column) -> Column:
    """The last ``severity:`` or ``cvss:`` tag; UNKNOWN without one."""
    last = F.try_element_at(F.filter(tags, lambda t: t.startswith("severity:") | t.isin(list(TAG_SCORES))), F.lit(-1))
    return F.coalesce(F.upper(F.regexp_replace(last, "^(severity|cvss):", "")), F.lit("UNKNOWN"))


def tag_score(tags: Column) -> Column:
    return lookup(TAG_SCORES, F.try_element_at(F.filter(tags, lambda t: t.isin(list(TAG_SCORES))), F.lit(-1)))


def actor_of(tags: Column) -> Column:
    """Name in the first actor tag, plain or from a galaxy."""
    told = F.filter(tags, lambda t: t.startswith("threat-actor:") | (F.contains(t, F.lit('threat-actor="'))))
    first = F.get(told, F.lit(0))
    return F.when(first.startswith("threat-actor:"), F.trim(_after(first, "threat-actor:"))).otherwise(F.trim(F.regexp_extract(first, '"([^"]*)"?', 1)))


def malware_of(tags: Column) -> Column:
    plain = lambda t: t.startswith("malware-type:")
    told = F.filter(tags, lambda t: plain(t) | F.contains(t, F.lit('malware="')))
    return F.transform(told, lambda t: F.when(plain(t), F.trim(_after(t, "malware-type:"))).otherwise(F.trim(F.regexp_extract(t, '"([^"]*)"?', 1))))


def techniques_of(tags: Column) -> Column:
    """Technique ids in attack-pattern tags."""
    told = F.filter(tags, lambda t: F.contains(t, F.lit("mitre-attack-pattern")) | t.startswith("mitre-attack:technique:"))
    return F.filter(F.transform(told, lambda t: F.regexp_extract(t, r"(T\d{4}(?:\.\d{3})?)", 1)), lambda x: x != "")


def sector_of(tags: Column) -> Column:
    first = F.get(F.filter(tags, lambda t: t.rlike("^(target-)?sector:")), F.lit(0))
    return F.lower(F.trim(F.regexp_replace(first, "^(target-)?sector:", "")))


def exploits_of(tags: Column) -> Column:
    """CVE ids of ``exploits:`` tags, in capitals."""
    told = F.transform(F.filter(tags, lambda t: t.startswith("exploits:")), lambda t: F.upper(F.trim(_after(t, "exploits:"))))
    return F.filter(told, lambda x: x.startswith("CVE-"))


def galaxy_technique(tag: Column) -> Column:
    """struct<id, name> of the technique in a galaxy tag ``...="Name - T1234"``; NULL if it names none."""
    end = F.regexp_extract(tag, r'-\s*(T\d{4}(?:\.\d{3})?)\s*"?$', 1)
    found = F.when(end != "", end).otherwise(F.regexp_extract(tag, r"(T\d{4}(?:\.\d{3})?)", 1))
    name = F.regexp_replace(F.regexp_replace(F.substring_index(tag, "=", -1), '^"+|"+$', ""), r"\s*-\s*T\d{4}(?:\.\d{3})?\s*$", "")
    return F.when((found != "") & F.contains(tag, F.lit("=")), F.struct(found.alias("id"), F.trim(name).alias("name")))


def cve_in(text: Column) -> Column:
    """The first CVE id in a text, in capitals; NULL without one."""
    return F.nullif(F.upper(F.regexp_extract(text, r"(?i)CVE-\d{4}-\d{4,}", 0)), F.lit(""))


def meta_list(comment: Column, prefix: str, key: str) -> Column:
    """Strings of the JSON that stands behind ``prefix``, up to the end of its line: a list, or an object's list under ``key``; empty if
    there is none or it is malformed."""
    line = F.trim(F.regexp_extract(comment, prefix + r"[ \t]*([^\n]*)", 1))
    listed = F.when(line.startswith("["), line).otherwise(F.get_json_object(line, "$." + key))
    return F.coalesce(F.when(F.try_parse_json(line).isNotNull(), F.from_json(listed, "array<string>")), F.array().cast("array<string>"))


def meta_json(comment: Column, prefix: str) -> Column:
    """The JSON behind a comment's prefix as text; NULL if there is none or it is malformed."""
    body = F.when(comment.startswith(prefix), _after(comment, prefix))
    return F.when(F.try_parse_json(body).isNotNull(), body)


def meta_score(meta: Column) -> Column:
    from .scalars import clamp_cvss

    return F.coalesce(clamp_cvss(F.get_json_object(meta, "$.cvss_v31_data.base_score")), clamp_cvss(F.get_json_object(meta, "$.cvss_v2_data.base_score")))
