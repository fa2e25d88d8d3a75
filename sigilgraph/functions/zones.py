"""Zone classification by weighted keywords."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Context weights, thresholds, keywords and excluding phrases of zones.
CONTEXTS = {"title": 3.0, "alias": 3.0, "name": 3.0, "description": 2.0, "body": 1.5, "tag": 1.0}
THRESHOLD = 1.5
FIELD_SCORES = {"name": 3.0, "title": 2.5, "description": 1.5, "tag": 0.5}
KEYWORDS = {
    "healthcare": [
        "hospital", "hospitals", "healthcare", "healthcare sector", "medical device", "medical devices", "medical imaging", "mri scan", "ct-scan",
        "xray", "x-ray", "ultrasound", "diagnostic imaging", "pacemaker", "insulin pump", "defibrillator", "dialysis", "pacs server", "ehr system",
        "medical", "electronic health record", "electronic medical records", "patient data", "medical records", "hipaa", "pharma", "pharmaceutical",
        "pharma company", "pharmacy", "drug manufacturer", "biomedical", "biotechnology", "clinical trial", "medical laboratory", "lab corporation",
        "diagnostic lab", "health clinic", "clinic", "medical center", "patient monitoring", "patient record", "patient portal", "dicom", "hl7",
        "fhir", "health it", "healthcare software", "clinical software", "telehealth",
    ],
    "energy": [
        "scada", "scada system", "industrial control", "industrial control system", "distributed control system", "plc controller",
        "programmable logic controller", "scada hmi", "electric grid", "power grid", "electrical grid", "substation", "power transformer",
        "electrical transformer", "power transmission", "distribution grid", "smart grid", "grid infrastructure", "power utility", "nuclear plant",
        "nuclear facility", "power plant", "oil pipeline", "gas pipeline", "pipeline scada", "refinery", "petrochemical", "oil refinery",
        "renewable energy", "solar farm", "wind farm", "hydro plant", "critical infrastructure", "energy sector", "ot security", "ot network",
        "operational technology", "industrial network", "modbus", "opc ua", "ethernet ip", "profinet", "substation automation",
        "grid load management", "grid operations", "energy management system",
    ],
    "finance": [
        "banking trojan", "financial trojan", "payment card", "credit card", "debit card", "card data", "card fraud", "atm malware", "pos malware",
        "point of sale", "banking", "banking sector", "financial sector", "investment firm", "investment bank", "trading platform", "stock exchange",
        "brokerage", "stock broker", "cryptocurrency exchange", "crypto exchange", "bitcoin exchange", "swift payment", "swift network",
        "swift transfer", "ach payment", "ach transfer", "wire transfer fraud", "fintech", "digital banking", "online banking", "insurance company",
        "insurance sector", "underwriting", "erp system", "sap erp", "sap system", "oracle financial", "accounting software", "know your customer",
        "anti money laundering", "fraud detection", "anti-fraud", "fraud prevention", "payment gateway", "payment processor", "merchant services",
        "financial services", "payment processing", "core banking", "core banking system", "trading system", "crypto wallet",
    ],
}
EXCLUDING = {
    "healthcare": [
        "not healthcare", "no healthcare", "except hospital", "excluding medical", "non-medical", "non-hospital", "unrelated to healthcare",
    ],
    "energy": [
        "not energy", "no energy", "except power", "excluding grid", "non-energy", "non-grid", "unrelated to energy",
    ],
    "finance": [
        "not finance", "no finance", "except bank", "excluding payment", "non-financial", "non-banking", "unrelated to finance",
    ],
}
INDUSTRIES = {
    "healthcare": "healthcare", "health": "healthcare", "medical": "healthcare", "pharmaceutical": "healthcare", "energy": "energy",
    "utilities": "energy", "oil": "energy", "gas": "energy", "finance": "finance", "banking": "finance", "financial": "finance",
    "insurance": "finance",
}


_UNIT = r"(?U)\w+\W*"
_BARE = r"(?U)\W+$"


def phrase_hits(text: Column, phrases: dict[str, list[str]]) -> Column:
    """map<name, long>: how often phrases of each name stand in a text, in one pass over its words; overlapping phrases each count.

    A phrase stands for itself between word borders, so its words, and what is between them, are some words of the text in a row. Only words
    that begin a phrase are looked at further. Raises ValueError for a phrase that does not begin and end with a letter, digit or
    underscore, and for one that can overlap itself."""
    import re

    table: dict[str, list[tuple[str, str, int]]] = {}
    for name, own in phrases.items():
        for p in dict.fromkeys(own):
            words = re.findall(r"\w+\W*", p)
            if not words or re.sub(r"\W*$", "", p) != p or re.match(r"\W", p):
                raise ValueError(f"no phrase of words: {p!r}")
            if any(words[k:] == [*words[: len(words) - k - 1], re.sub(r"\W+$", "", words[len(words) - k - 1])] for k in range(1, len(words))):
                raise ValueError(f"a phrase that can overlap itself: {p!r}")
            table.setdefault(re.sub(r"\W+$", "", words[0]), []).append((name, p, len(words)))
    low = F.lower(F.coalesce(text, F.lit("")))
    bare = lambda u: F.regexp_replace(u, _BARE, "")
    known = F.create_map(*[x for first, own in table.items() for x in (F.lit(first), F.array(*[F.struct(F.lit(n).alias("name"), F.lit(p).alias("phrase"), F.lit(k).alias("words")) for n, p, k in own]))])

    def found(units: Column) -> Column:
        """Names of the phrases that stand in the words, each as often as it does."""
        starts = F.filter(F.transform(units, lambda u, i: F.struct(bare(u).alias("word"), i.alias("at"))), lambda x: x["word"].isin(list(table)))
        # A phrase of some words: those from here, joined, without what follows the last.
        here = lambda x, p: bare(F.array_join(F.slice(units, x["at"] + 1, p["words"]), "")) == p["phrase"]
        return F.flatten(F.transform(starts, lambda x: F.transform(F.filter(known[x["word"]], lambda p: here(x, p)), lambda p: p["name"])))

    def times(names: Column, name: str) -> Column:
        return F.size(F.filter(names, lambda n: n == name)).cast("long")

    count = lambda names: F.map_from_arrays(F.array(*map(F.lit, phrases)), F.array(*[times(names, n) for n in phrases]))
    return _once(F.regexp_extract_all(low, F.lit(_UNIT), F.lit(0)), lambda units: _once(found(units), count))


def _once(value: Column, f) -> Column:
    """``f`` of a value that is computed once: lambdas compute again what they name from outside, but not their own variable."""
    return F.element_at(F.transform(F.array(value), f), 1)


def zone_scores(text: Column, context: str = "body", keywords: dict | None = None, excluding: dict | None = None) -> Column:
    """struct<zone: double>: weight of the context times keyword hits; overlapping keywords each count; 0 where an excluding phrase stands."""
    weight = F.lit(CONTEXTS.get(context, 1.0)).cast("double")
    keywords, excluding = keywords or KEYWORDS, EXCLUDING if excluding is None else excluding
    hits = phrase_hits(text, {**{f"+{z}": w for z, w in keywords.items()}, **{f"-{z}": w for z, w in excluding.items() if w}})
    score = lambda h, z: F.when(F.coalesce(h[f"-{z}"], F.lit(0)) > 0, 0.0).otherwise(h[f"+{z}"].cast("double") * weight)
    return _once(hits, lambda h: F.struct(*[score(h, z).alias(z) for z in keywords]))


def detect_zones(df: DataFrame, text: str, context: str = "body", out: str = "zones", default: str = "global", **tables) -> DataFrame:
    """Adds the zones of a text that reach the threshold, or ``default``. One pass over the text's words for all phrases, in the JVM."""
    scored = df.withColumn("__z", zone_scores(F.col(text), context, **tables))
    names = list((tables.get("keywords") or KEYWORDS))
    hit = F.array_compact(F.array(*[F.when(F.col("__z")[z] >= THRESHOLD, F.lit(z)) for z in names]))
    return scored.withColumn(out, F.when(F.size(hit) > 0, hit).otherwise(F.array(F.lit(default)))).drop("__z")


def detect_item_zones(df: DataFrame, fields: dict[str, str], out: str = "zones", keywords: dict | None = None) -> DataFrame:
    """Zones of an item from several fields (column -> kind): a matching field adds its kind's score; kept are zones with half the best
    score and the threshold at least."""
    keywords = keywords or KEYWORDS
    for k, (column, kind) in enumerate(fields.items()):
        df = detect_zones(df, column, "name" if kind == "name" else kind, f"__f{k}", keywords=keywords)
    sums = {z: sum((F.when(F.array_contains(f"__f{k}", z), FIELD_SCORES[kind]).otherwise(0.0) for k, kind in enumerate(fields.values())), F.lit(0.0).cast("double")) for z in keywords}
    best = F.greatest(*sums.values()) if len(sums) > 1 else next(iter(sums.values()))
    hit = F.array_compact(F.array(*[F.when((s >= THRESHOLD) & (s >= 0.5 * best), F.lit(z)) for z, s in sums.items()]))
    return df.withColumn(out, F.when(F.size(hit) > 0, hit).otherwise(F.array(F.lit("global")))).drop(*[f"__f{k}" for k in range(len(fields))])
