"""Clamps, time coercion, tiers and small rules of feeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tier bounds and factors, type maps, thresholds.
EVENT_TIERS = [(10, 0.50), (20, 0.45), (100, 0.40), (500, 0.35)]
EVENT_TIER_REST = 0.30
DECAY = {"Indicator": [(90, 180, 0.85), (180, 365, 0.70)], "Vulnerability": [(90, 180, 0.90), (180, 365, 0.80)]}
RETIRE_AFTER, DECAY_FLOOR = 365, 0.10
FIRST_PLAUSIBLE = "1995-01-01"
ATTRIBUTE_TYPES = {
    "ip-dst": "ipv4", "ip-src": "ipv4", "ipv4": "ipv4", "ipv6": "ipv6", "domain": "domain", "hostname": "domain", "url": "url",
    "md5": "hash", "sha1": "hash", "sha256": "hash", "sha512": "hash", "email-src": "email", "email-dst": "email",
    "vulnerability": "cve", "filename": "filename", "regkey": "registry", "mutex": "mutex", "yara": "yara", "sigma": "sigma",
    "snort": "snort", "btc": "bitcoin", "text": "unknown",
}
IOC_TYPES = {
    "domain": "domain", "ip:port": "ipv4", "ip": "ipv4", "ipv4": "ipv4", "ipv6": "ipv6", "url": "url", "md5_hash": "md5",
    "sha1_hash": "sha1", "sha256_hash": "sha256", "sha3_384_hash": "sha384", "sha512_hash": "sha512", "ssdeep": "hash",
}


def lookup(table: dict, key: Column, default=None) -> Column:
    """A literal map's value; ``default`` (NULL if None) for other keys."""
    found = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[key]
    return found if default is None else F.coalesce(found, F.lit(default))


def clamp_cvss(c: Column) -> Column:
    """A score in [0, 10], NULL for others, NaN and text."""
    x = c.try_cast("double")
    return F.when(~F.isnan(x) & x.between(0, 10), x)


def clamp_confidence(c: Column) -> Column:
    """A confidence in [0, 1]; 0.5 for everything else."""
    x = c.try_cast("double")
    return F.when(~F.isnan(x) & x.between(0, 1), x).otherwise(F.lit(0.5).cast("double"))


def cve_of(cve_id: Column, kind: Column, value: Column) -> Column:
    strip = lambda c: F.nullif(F.upper(F.trim(c)), F.lit(""))
    return F.coalesce(strip(cve_id), F.when(kind == "vulnerability", strip(value)))


def iso_time(c: Column) -> Column:
    """A timestamp from epoch seconds or ISO text: date only is midnight UTC; NULL if malformed."""
    s = F.trim(c.cast("string"))
    epoch = s.try_cast("bigint")
    ok = s.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?$")
    return F.when(s.rlike(r"^\d+$"), F.when(epoch.between(1, 253402300799), F.timestamp_seconds(epoch))).when(ok, s.try_cast("timestamp"))


def plausible(ts: Column, as_of: Column) -> Column:
    """NULL before 1995, at most ``as_of``."""
    return F.when(ts >= F.lit(FIRST_PLAUSIBLE).cast("timestamp"), F.least(ts, as_of))


def is_wall_clock(ts: Column, as_of: Column, seconds: int = 300) -> Column:
    """Whether a reported time is just the time of collection."""
    return F.coalesce(F.abs(F.unix_timestamp(ts) - F.unix_timestamp(as_of)) <= seconds, F.lit(False))


def days_between(a: Column, b: Column) -> Column:
    """Whole 24-hour days."""
    return F.timestamp_diff("DAY", a, b)


def event_tier(size: Column) -> Column:
    out = F.when(size <= EVENT_TIERS[0][0], F.lit(EVENT_TIERS[0][1]).cast("double"))
    for most, value in EVENT_TIERS[1:]:
        out = out.when(size <= most, F.lit(value).cast("double"))
    return out.otherwise(F.lit(EVENT_TIER_REST).cast("double"))


def decay_tier(age: Column) -> Column:
    """Name of the age tier, NULL below 90 days; day 365 belongs to none, later days retire."""
    out = F.when(age > RETIRE_AFTER, F.lit("retired"))
    for lo, hi, _ in DECAY["Indicator"]:
        out = out.when((age >= lo) & (age < hi), F.lit(f"{lo}-{hi}"))
    return out


def decayed(label: str, confidence: Column, age: Column) -> Column:
    """Confidence after one tier's decay: rounded to two places, not below the floor."""
    out = None
    for lo, hi, factor in DECAY[label]:
        value = F.greatest(F.round(confidence * F.lit(factor).cast("double") * 100) / 100, F.lit(DECAY_FLOOR).cast("double"))
        here = (age >= lo) & (age < hi)
        out = F.when(here, value) if out is None else out.when(here, value)
    return out.otherwise(confidence)


def zone_fold(zones: Column) -> Column:
    """Specific zones override ``global``; sorted and distinct."""
    z = F.array_distinct(zones)
    specific = F.filter(z, lambda x: x != "global")
    return F.array_sort(F.when(F.size(specific) > 0, specific).otherwise(z))


def hash_kind(value: Column) -> Column:
    return F.when(F.length(value) == 32, "md5").when(F.length(value) == 40, "sha1").otherwise("sha256")


def infer_type(value: Column) -> Column:
    """Attribute type from a value's looks."""
    octet = r"(25[0-5]|2[0-4]\d|1\d\d|0*\d?\d)"
    v, low, n = value, F.lower(value), F.length(value)
    hexa = v.rlike("^[0-9a-fA-F]+$")
    out = F.when(v.rlike(rf"^{octet}(\.{octet}){{3}}$"), "ip-dst")
    for size, kind in ((32, "md5"), (40, "sha1"), (64, "sha256"), (128, "sha512")):
        out = out.when(hexa & (n == size), kind)
    out = out.when(low.startswith("cve-"), "vulnerability").when(low.rlike("^https?://"), "url")
    return out.when(F.contains(v, F.lit("@")) & F.contains(v, F.lit(".")), "email-src").when(F.contains(v, F.lit(".")), "domain").otherwise("text")


def ransomware_severity(flag: Column) -> tuple[Column, Column]:
    """(severity, score) of a known-exploited entry."""
    known, unknown = flag == "Known", flag == "Unknown"
    severity = F.when(known, "CRITICAL").when(unknown, "HIGH").otherwise("MEDIUM")
    return severity, F.when(known, F.lit(9.0)).when(unknown, F.lit(7.0)).otherwise(F.lit(5.0)).cast("double")


def verdict_confidence(malicious: Column, suspicious: Column, total: Column) -> Column:
    raw = F.lit(0.5).cast("double") + F.lit(0.45).cast("double") * (malicious + F.lit(0.5).cast("double") * suspicious) / total
    return F.when(total > 0, F.round(F.least(F.lit(0.95).cast("double"), raw), 2)).otherwise(F.lit(0.5).cast("double"))


def aliases_clean(names: Column, reject, most: int = 50, width: int = 200) -> Column:
    """Aliases without blanks and placeholders, each at most ``width`` signs, the first ``most``."""
    kept = F.filter(names, lambda x: x.isNotNull() & ~reject(x))
    return F.slice(F.transform(kept, lambda x: F.left(F.trim(x), F.lit(width))), 1, most)


def clean_value(value: Column, most: int = 255) -> Column:
    bare = F.trim(F.regexp_replace(F.coalesce(value, F.lit("")), "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]", ""))
    return F.when(F.length(bare) > most, F.concat(F.left(bare, F.lit(most - 3)), F.lit("..."))).otherwise(bare)


def accepted_value(value: Column, most_bytes: int = 4096) -> Column:
    return F.coalesce((F.trim(value) != "") & (F.octet_length(value) <= max(64, most_bytes)), F.lit(False))


def stix_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def stix_pattern(kind: Column, value: Column) -> Column:
    """Pattern of an indicator; NULL for types without one."""
    safe = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    objects = {"ipv4": "ipv4-addr:value", "ipv6": "ipv6-addr:value", "domain": "domain-name:value", "url": "url:value", "email": "email-addr:value"}
    name = F.when(kind.isin("md5", "sha1", "sha256", "sha512"), F.concat(F.lit("file:hashes.'"), F.upper(kind), F.lit("'"))).otherwise(lookup(objects, kind))
    return F.concat(F.lit("["), name, F.lit(" = '"), safe, F.lit("']"))


def pattern_value(pattern: Column) -> Column:
    """The value inside a comparison pattern, unescaped."""
    raw = F.nullif(F.regexp_extract(pattern, r"=\s*'((?:[^'\\]|\\.)*)'", 1), F.lit(""))
    return F.replace(F.replace(raw, F.lit("\\'"), F.lit("'")), F.lit("\\\\"), F.lit("\\"))


def cpe_text(cpe: Column) -> Column:
    """criteria, vendor and product of a CPE name, joined by blanks."""
    p = F.split(cpe, ":", -1)
    return F.array_join(F.array_compact(F.array(cpe, F.get(p, F.lit(3)), F.get(p, F.lit(4)))), " ")


def attack_vector(vector: Column) -> Column:
    letter = F.regexp_extract(vector, "AV:([A-Z])", 1)
    return F.coalesce(lookup({"N": "NETWORK", "A": "ADJACENT_NETWORK", "L": "LOCAL", "P": "PHYSICAL"}, letter), F.lit("UNKNOWN"))


def request_days(days: Column) -> Column:
    """How far back a feed may be asked: 1 to 7 days."""
    return F.greatest(F.lit(1), F.least(F.lit(7), days))


def month_cutoff(as_of: Column, months: Column) -> Column:
    """The date ``months`` average Gregorian months ago, in whole days."""
    return F.date_sub(as_of, F.floor(months * F.lit(30.437)).cast("int"))


def event_size(*counts: Column) -> Column:
    """An event's size from the first of several counts, as text, that is a whole number; 0 if none is."""
    return F.coalesce(*[c.try_cast("int") for c in counts], F.lit(0))
