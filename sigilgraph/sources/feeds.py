"""Readers of feed files: each turns raw records into items (kind, indicator_type, value, source and more)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import tags as G
from ..functions.zones import detect_zones
from ..operators.merge import first_of


def _items(df: DataFrame, source: str, kind: str = "indicator") -> DataFrame:
    return df.withColumn("source", F.lit(source)).withColumn("kind", F.lit(kind))


def pulses(spark: SparkSession, path: str) -> DataFrame:
    """Pulse feed (JSON lines): indicators, malware, CVEs and actors of each pulse; its metadata goes to each item."""
    raw = spark.read.schema("id string, name string, created string, adversary string, tags array<string>, malware_families array<string>, attack_ids array<string>, industries array<string>, indicators array<struct<type:string, indicator:string>>").json(path)
    base = raw.select(F.col("id").alias("pulse"), "name", S.iso_time(F.col("created")).alias("seen"), "tags", "attack_ids", "adversary", "malware_families", "indicators")
    meta = ["pulse", "seen", "tags", "attack_ids"]
    ind = base.select(*meta, F.explode("indicators").alias("i"))
    cve = F.upper(F.col("i.type")) == "CVE"
    parts = [
        ind.select(*meta, F.when(cve, "vulnerability").otherwise("indicator").alias("kind"), F.lower(F.col("i.type")).alias("indicator_type"), F.when(cve, F.upper(F.col("i.indicator"))).otherwise(F.col("i.indicator")).alias("value")),
        base.select(*meta, F.lit("malware").alias("kind"), F.lit(None).cast("string").alias("indicator_type"), F.explode("malware_families").alias("value")),
        base.where(F.trim("adversary") != "").select(*meta, F.lit("actor").alias("kind"), F.lit(None).cast("string").alias("indicator_type"), F.trim("adversary").alias("value")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("source", F.lit("alienvault_otx"))


def cve_feed(spark: SparkSession, path: str) -> DataFrame:
    """CVE records (JSON lines): score by version 3.1, 3.0, then 2; vector, weaknesses, products, at most ten version constraints."""
    score = "struct<baseScore:double, baseSeverity:string, vectorString:string>"
    raw = spark.read.schema(f"id string, published string, description string, v31 {score}, v30 {score}, v2 {score}, weaknesses array<array<string>>, cpes array<string>").json(path)
    best = F.coalesce("v31", "v30", "v2")
    cwes = F.array_sort(F.array_distinct(F.flatten("weaknesses")))
    return _items(raw.select(F.upper("id").alias("value"), S.iso_time(F.col("published")).alias("seen"), "description", S.clamp_cvss(best["baseScore"]).alias("score"), F.coalesce(F.upper(best["baseSeverity"]), F.lit("UNKNOWN")).alias("severity"), S.attack_vector(best["vectorString"]).alias("attack_vector"), cwes.alias("cwes"), F.slice("cpes", 1, 10).alias("version_constraints"), F.transform("cpes", S.cpe_text).alias("products")), "nvd", "vulnerability")


def windows(start, end, days: int = 120) -> list[tuple]:
    """Date ranges of at most ``days`` that tile [start, end], newest first."""
    from datetime import timedelta

    out = []
    while start <= end:
        lo = max(start, end - timedelta(days=days - 1))
        out.append((lo, end))
        end = lo - timedelta(days=1)
    return out


def windows_table(df: DataFrame, start: str, end: str, days: int = 120) -> DataFrame:
    """Each row once for every date range (lo, hi) of at most ``days`` that tiles its [start, end]; ``window`` counts from the newest.
    Rows whose start lies behind their end, or is NULL, have none."""
    count = F.floor(F.datediff(end, start) / F.lit(days)).cast("int")
    rows = df.where(F.col(start) <= F.col(end)).withColumn("window", F.explode(F.sequence(F.lit(0), count)))
    hi = F.date_sub(end, F.col("window") * days)
    return rows.withColumns({"lo": F.greatest(F.col(start), F.date_sub(hi, days - 1)), "hi": hi})


def known_exploited(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema("cveID string, dateAdded string, knownRansomwareCampaignUse string").json(path)
    severity, score = S.ransomware_severity(F.col("knownRansomwareCampaignUse"))
    return _items(raw.select(F.upper("cveID").alias("value"), S.iso_time(F.col("dateAdded")).alias("seen"), severity.alias("severity"), score.alias("score")), "cisa_kev", "vulnerability")


#: Knowledge-base object types and the kinds of items they are.
ATTACK_KINDS = {"intrusion-set": "actor", "malware": "malware", "tool": "tool", "attack-pattern": "technique"}


def attack_relations(spark: SparkSession, path: str) -> DataFrame:
    """Resolved relations of a knowledge-base bundle (JSON lines of objects): type, then type, name and id of source and target. An actor,
    malware or tool ``uses`` a technique, a technique is ``subtechnique_of`` another, malware is ``attributed_to`` an actor; other
    relations, and those with an end that the bundle lacks, are dropped."""
    raw = spark.read.schema("id string, type string, name string, mitre_id string, relationship_type string, source_ref string, target_ref string").json(path)
    things = raw.select("id", S.lookup(ATTACK_KINDS, F.col("type")).alias("kind"), "name", "mitre_id").where(F.col("kind").isNotNull())
    end = lambda p: things.select(F.col("id").alias(f"{p}_ref"), F.col("kind").alias(f"{p}_type"), F.col("name").alias(f"{p}_name"), F.col("mitre_id").alias(f"{p}_id"))
    rel = raw.where("type = 'relationship'").select(F.replace("relationship_type", F.lit("-"), F.lit("_")).alias("type"), "source_ref", "target_ref")
    kind, src, trg = F.col("type"), F.col("source_type"), F.col("target_type")
    allowed = (kind == "uses") & src.isin("actor", "malware", "tool") & (trg == "technique")
    allowed |= (kind == "subtechnique_of") & (src == "technique") & (trg == "technique")
    allowed |= (kind == "attributed_to") & (src == "malware") & (trg == "actor")
    return rel.join(end("source"), "source_ref").join(end("target"), "target_ref").where(allowed).drop("source_ref", "target_ref")


def attack_bundle(spark: SparkSession, path: str) -> DataFrame:
    """Technique ids that each actor, malware and tool of a knowledge-base bundle uses."""
    uses = attack_relations(spark, path).where("type = 'uses' AND target_id <> ''")
    return uses.groupBy(F.col("source_type").alias("kind"), F.col("source_name").alias("name")).agg(F.array_sort(F.collect_set("target_id")).alias("uses_techniques"))


def ioc_feed(spark: SparkSession, path: str) -> DataFrame:
    """IOC records: ``ip:port`` loses its port, confidence is of 100."""
    raw = spark.read.schema("ioc string, ioc_type string, malware string, confidence_level int").json(path)
    value = F.when(F.col("ioc_type") == "ip:port", F.regexp_replace("ioc", ":[^:]*$", "")).otherwise(F.col("ioc"))
    return _items(raw.select(S.lookup(S.IOC_TYPES, F.col("ioc_type"), "unknown").alias("indicator_type"), value.alias("value"), F.lower("malware").alias("malware"), (F.col("confidence_level") / F.lit(100.0)).alias("confidence")), "threatfox")


def url_feed(spark: SparkSession, path: str) -> DataFrame:
    """CSV with ``#`` comments; the first row of a URL wins, by its own id. Zones are those of the threat, or of the tags where the
    threat names none."""
    raw = spark.read.schema("id long, dateadded string, url string, status string, last_online string, threat string, tags string, link string, reporter string").option("comment", "#").csv(path)
    named = raw.withColumn("url", F.trim("url")).where(F.col("url").startswith("http")).withColumnRenamed("url", "value")
    rows = detect_zones(detect_zones(first_of(named, ["value"], ["id"]), "threat", out="__by_threat"), "tags", out="__by_tags")
    told = F.col("__by_threat") != F.array(F.lit("global"))
    times = {"seen": S.iso_time(F.col("dateadded")), "last_seen": S.iso_time(F.col("last_online"))}
    out = rows.withColumns({"zones": F.when(told, F.col("__by_threat")).otherwise(F.col("__by_tags")), "indicator_type": F.lit("url"), "confidence": F.lit(0.6), **times})
    return _items(out.drop("__by_threat", "__by_tags"), "urlhaus")


def hash_lines(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.text(path).select(F.lower(F.trim("value")).alias("value")).where(F.col("value").rlike("^[0-9a-f]+$"))
    return _items(raw.withColumn("indicator_type", S.hash_kind(F.col("value"))), "cybercure").distinct()


def blocklist(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema("first_seen string, ip string, port int, status string, last_online string, malware string").option("comment", "#").csv(path)
    return _items(raw.select(F.lit("ipv4").alias("indicator_type"), F.col("ip").alias("value"), F.lower("malware").alias("malware"), S.iso_time(F.col("first_seen")).alias("seen")), "feodo_tracker")


def certificates(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema("listed string, sha1 string, reason string").option("comment", "#").csv(path)
    return _items(raw.select(F.lit("sha1").alias("indicator_type"), F.lower("sha1").alias("value"), "reason"), "ssl_blacklist")


def ip_reputation(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema("ipAddress string, abuseConfidenceScore int, reports array<struct<categories:array<int>>>").json(path)
    cats = F.array_sort(F.array_distinct(F.flatten(F.transform(F.slice("reports", 1, 5), lambda r: r["categories"]))))
    return _items(raw.select(F.when(F.contains("ipAddress", F.lit(".")), "ipv4").otherwise("ipv6").alias("indicator_type"), F.col("ipAddress").alias("value"), (F.col("abuseConfidenceScore") / F.lit(100.0)).alias("confidence"), cats.alias("abuse_categories")), "abuseipdb")


def verdicts(spark: SparkSession, path: str) -> DataFrame:
    """Reputation of files and URLs (JSON lines): confidence from the engines' counts, 0.5 without any."""
    raw = spark.read.schema("value string, kind string, stats struct<malicious:int, suspicious:int, harmless:int, undetected:int>").json(path)
    n = {k: F.coalesce(F.col(f"stats.{k}"), F.lit(0)) for k in ("malicious", "suspicious", "harmless", "undetected")}
    confidence = S.verdict_confidence(n["malicious"], n["suspicious"], sum(n.values(), F.lit(0)))
    return _items(raw.select(F.lower("kind").alias("indicator_type"), "value", n["malicious"].alias("malicious"), confidence.alias("confidence")), "virustotal")


def look_up(asked: DataFrame, reputation: DataFrame) -> DataFrame:
    """Items (indicator_type, value) with what a reputation table (the same keys and more) says of them: its best confidence decides
    between repeated rows; items it lacks stay, with NULL."""
    known = reputation.groupBy("indicator_type", "value").agg(F.max("confidence").alias("confidence"), F.max("malicious").alias("malicious"))
    return asked.join(known, ["indicator_type", "value"], "left")


def galaxy_items(attrs: DataFrame) -> DataFrame:
    """Exploded attributes with the techniques that their galaxy tags name (array of id, name) and the first CVE id in their value."""
    told = F.transform("tags", G.galaxy_technique)
    return attrs.withColumns({"techniques": F.filter(told, lambda x: x.isNotNull()), "cve_id": G.cve_in(F.col("value"))})


def staging_events(spark: SparkSession, path: str) -> DataFrame:
    """Nested staging events (JSON lines)."""
    return spark.read.schema("id string, info string, date date, ts timestamp, tags array<struct<name:string>>, attributes array<struct<type:string, value:string, comment:string, tags:array<struct<name:string>>>>").json(path)
