"""Set joins, decontamination and the pipeline against brute force on small fixtures."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigilgraph.llm import decontaminate, line_dedup, ngram_join
from sigilgraph.llm.components import components

SF = "/root/testdata/sf0.001"
VOCAB = [f"w{i}" for i in range(400)]


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def shingle_set(t, k):
    w = words(t)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(rows, k, percent):
    sets = [(i, shingle_set(t, k)) for i, t in rows]
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if x and y and i is not None and j is not None and 100 * len(x & y) >= percent * len(x | y):
                group[root(a)] = root(b)
    least = {}
    for n, (i, s) in enumerate(sets):
        if i is not None:
            least[root(n)] = min(least.get(root(n), i), i)
    return sorted((str(i), len(s), str(least.get(root(n), i) if s else i)) for n, (i, s) in enumerate(sets))


def noisy_rows(seed, groups=12, copies=9):
    """Groups of drifting copies, more of them than a short list holds, with a passage that many texts share."""
    r = random.Random(seed)
    passage = " ".join(r.choice(VOCAB) for _ in range(30))
    rows, i = [], 0
    for g in range(groups):
        base = [r.choice(VOCAB) for _ in range(r.randint(3, 120))]
        for _ in range(r.randint(1, copies)):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                w[r.randrange(len(w))] = r.choice(VOCAB)
            if r.random() < 0.3:
                base = w  # the next copies drift on
            rows.append((i, " ".join(w) + (("\n" + passage) if r.random() < 0.3 else "")))
            i += 1
    return rows + [(900, None), (901, ""), (902, " \n "), (903, "one"), (904, "One"), (None, rows[0][1]), (905, rows[1][1]), (905, "a b c d e f g h")]


@pytest.mark.parametrize("seed,k,percent", [(1, 4, 85), (2, 5, 80), (3, 2, 60), (4, 1, 85)])
def test_ngram_join_equals_brute_force(spark, seed, k, percent):
    rows = noisy_rows(seed)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, node string")
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in ngram_join.similar_documents(docs, shingle=k, percent=percent).collect())
    assert got == brute_components(rows, k, percent)


def test_ngram_join_finds_a_pair_in_a_family_below_the_threshold(spark):
    """Members of a family share rare words but do not link, except for one pair of near copies."""
    r = random.Random(3)
    family, often = [f"t{i}" for i in range(200)], [f"v{i}" for i in range(900)]
    rows = [(100 + k, " ".join(r.sample(often, 300))) for k in range(150)]
    rows += [(k, " ".join(family + often[28 * k : 28 * k + 28])) for k in range(30)]
    rows.append((40, rows[150][1] + " near"))  # neither is among the least nodes of the family
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(x["doc_id"]), x["n_shingles"], str(x["component_id"])) for x in ngram_join.similar_documents(docs, shingle=1, percent=80).collect())
    want = brute_components(rows, 1, 80)
    assert sum(i != c for i, _, c in want) == 1
    assert got == want


def test_pairs_of_a_family_below_the_threshold_stay_in_the_cells(spark):
    """Texts of some 400 words share seven in ten and do not link: not all of their pairs may leave the tasks that compare them."""
    from sigilgraph.llm import rarity, setjoin

    r = random.Random(4)
    family, often = [f"t{i}" for i in range(330)], [f"v{i}" for i in range(900)]
    rows = [(1000 + k, " ".join(r.sample(often, 300))) for k in range(400)]
    rows += [(k, " ".join(family + r.sample(often, 70 + k % 8))) for k in range(80)]
    rows.append((500, rows[-1][1] + " near"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    units = ngram_join.units(docs, 1, 85, rarity.broadcast_table(docs)).cache()
    found = setjoin.candidate_pairs(setjoin.postings(units), 85, 2)
    sketched = setjoin.sketches(found, units.select("node", "sig"))
    none = spark.createDataFrame([], "node long, s long")
    plain = setjoin.left_over(found, none, 85, occurrences=2)
    kept = setjoin.left_over(found, none, 85, occurrences=2, sketched=sketched)
    assert plain.count() > 1_000 and kept.count() < plain.count() / 10
    both = [{(p["a"], p["b"]) for p in setjoin.verified(x, ngram_join.sets(docs, 1, spark.sparkContext.broadcast(setjoin.node_filter(x))), 85).collect()} for x in (plain, kept)]
    assert both[0] == both[1] and len(both[0]) == 1
    got = sorted((str(x["doc_id"]), x["n_shingles"], str(x["component_id"])) for x in ngram_join.similar_documents(docs, shingle=1, percent=85).collect())
    assert got == brute_components(rows, 1, 85)


@pytest.mark.parametrize("seed", [5, 6])
def test_ngram_join_with_cut_lists_equals_brute_force(spark, seed):
    """Lists of more than eight documents are cut, and left-over pairs are looked at in cells of four."""
    rows = noisy_rows(seed, groups=5, copies=40)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in ngram_join.similar_documents(docs, shingle=2, percent=85, longer=8, cell=4).collect())
    assert got == brute_components(rows, 2, 85)


def test_a_long_list_is_cut_and_bounded(spark):
    """6,000 texts with one header: no task gets the whole list, and pairs do not grow with its square."""
    r = random.Random(9)
    header = " ".join(f"h{i}" for i in range(40))
    rows = [(k, f"{header} n{r.randrange(100)} m{r.randrange(100)} o{r.randrange(100)}") for k in range(6_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    from sigilgraph.llm import rarity, setjoin

    posts = setjoin.postings(ngram_join.units(docs, 1, 85, rarity.broadcast_table(docs)))
    found = setjoin.candidate_pairs(posts, 85, 2)
    nodes = posts.select("node").distinct().count()
    assert nodes > 5_900 and found.where("c is not null").count() < 300 * nodes
    lists = posts.groupBy((posts["k"].bitwiseAND(~65535)).alias("list")).count().agg({"count": "max"}).first()[0]
    assert lists > 0.9 * nodes
    got = ngram_join.similar_documents(docs, shingle=1, percent=85)
    assert got.select("component_id").distinct().count() == 1


def test_ngram_join_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    from sigilgraph.llm.queries import op2_ngram_jaccard

    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in op2_ngram_jaccard(spark, SF).collect())
    assert got == brute_components(rows, 4, 85)


def test_ngram_join_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.similar_documents(docs).count() == 0


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 9), (5, 5), (20, 7), (7, 3), (None, 4)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 1, 20: 1, 8: 8, 9: 8}


def brute_lines(rows, percent=80, least=1):
    lines = []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for n, line in enumerate((t or "").split("\n")):
            s = frozenset(words(line))
            if len(s) >= least:
                lines.append((i, n, s))
    gone = {}
    for a, (i, n, s) in enumerate(lines):
        if any(100 * len(s & q) >= percent * len(s | q) for _, _, q in lines[:a]):
            gone.setdefault(i, []).append(n)
    return gone


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_equals_brute_force(spark, seed):
    r = random.Random(seed)
    rows = [(n, None if t is None else t.replace(" w1", "\nw1")) for n, (i, t) in enumerate(noisy_rows(seed)) if i != 905]
    rows += [(700, "w1 w2 w3 w4 w5\nw5 w4 w3 w2 w1 w1\nx\nx"), (None, "w1 w2 w3 w4 w5"), (701, "a b c d\na b c d e\nb\n\n \nB b"), (702, "a b c d e\na b c d\na b c")]
    r.shuffle(rows)
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, line int")
    got = {x["doc_id"]: x["removed"] for x in line_dedup.counts(docs).collect() if x["n_removed"]}
    want = brute_lines(rows)
    assert got == want
    texts = {x["doc_id"]: x["text"] for x in line_dedup.dedup_lines(docs).collect()}
    for i, t in rows:
        assert texts[i] == (t if i not in want else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in want[i]))


def test_line_dedup_with_cut_lists_equals_brute_force(spark):
    rows = [(n, None if t is None else t.replace(" w1", "\nw1")) for n, (i, t) in enumerate(noisy_rows(7, groups=5, copies=40)) if i != 905]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: x["lines"] for x in line_dedup.removed_lines(docs, longer=8, cell=4).collect()}
    assert got == brute_lines(rows)


def test_line_dedup_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {x["doc_id"]: x["removed"] for x in line_dedup.counts(docs).collect() if x["n_removed"]}
    assert got == brute_lines([(x["doc_id"], x["text"]) for x in docs.collect()])


def test_a_text_in_many_tasks_is_posted_once(spark):
    """Postings of equal sets from many tasks count once in each list, and pair with nothing twice."""
    from sigilgraph.llm import rarity, setjoin

    rows = [(k, "one two three four five six seven eight") for k in range(256)] + [(900 + k, f"one two three four five six seven n{k}") for k in range(3)] + [(990, "nine ten")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(64)
    posts = setjoin.postings(ngram_join.units(docs, 1, 60, rarity.broadcast_table(docs)))
    assert posts.count() > 2 * posts.distinct().count()
    found = setjoin.candidate_pairs(posts, 60, 2).where("c IS NOT NULL")
    lists = posts.select("node", (posts["k"].bitwiseAND(~65535)).alias("list")).distinct().groupBy("list").count()
    assert found.count() <= lists.selectExpr("sum(count * (count - 1) / 2)").first()[0]
    got = {x["doc_id"]: x["component_id"] for x in ngram_join.similar_documents(docs, shingle=1, percent=60).collect()}
    assert {got[k] for k in range(256)} | {got[900 + k] for k in range(3)} == {0} and got[990] == 990


def test_line_dedup_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    assert line_dedup.counts(docs).collect() == [] and line_dedup.dedup_lines(docs).collect() == []


@pytest.mark.parametrize("words_", [5, 25, 120])
def test_fingerprints_recall_windows_just_above_the_threshold(spark, words_):
    """Windows with a similarity of 0.80 to 0.85 to an item: at least nine of ten are within the radius."""
    r = random.Random(words_)
    items = [(k, " ".join(f"v{r.randrange(400)}" for _ in range(r.randint(60, 60 + words_)))) for k in range(40)]
    rows, n = [], 0
    for k, text in items:
        own = text.split()
        for _ in range(6):
            w = list(own)
            for _ in range(r.randint(1, 3)):
                w[r.randrange(len(w))] = f"u{n}"
                n += 1
            rows.append((len(rows), " ".join(w)))
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    loose = {(x["doc_id"], x["item_id"]) for x in decontaminate.find(docs, bench).collect()}
    ready = decontaminate.prepare(items)
    want = set()
    for d, text in rows:
        s, k = decontaminate._runs(decontaminate._words(text), decontaminate.SHINGLE), d // 6
        u, times = np.unique(s, return_counts=True)
        w = ready.weigh(u)[0]
        shared = sum(x * min(c, ready.counts[k].get(h, 0)) for h, c, x in zip(u.tolist(), times.tolist(), w))
        if 0.8 <= shared / ((w * times).sum() + ready.mass[k] - shared) <= 0.85:
            want.add((d, items[k][0]))
    assert len(want) >= 10 and len(want & loose) >= 0.9 * len(want)


def test_decontamination(spark):
    r = random.Random(5)
    items = [(k, " ".join(r.choice(VOCAB) for _ in range(r.randint(12, 40)))) for k in range(30)] + [(50, "only three words"), (51, None), (None, "w1 w2 w3 w4 w5 w6"), (52, "")]
    rows = []
    for n in range(120):
        w = [r.choice(VOCAB) for _ in range(r.randint(0, 200))]
        if n % 3 == 0:
            own = items[r.randrange(30)][1].split()
            if n % 2:
                own[r.choice([0, -1, r.randrange(len(own))])] = "changed"
            w[len(w) // 2 : len(w) // 2] = own
        rows.append((n, " ".join(w).replace(" w7 ", ", W7. ")))
    rows += [(500, "see Only THREE words."), (501, None), (502, ""), (None, items[3][1])]

    def tokens(t):
        return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))

    import math
    from collections import Counter

    grams = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    real = {k: tokens(t) for k, t in items if k is not None and tokens(t)}
    long_ = {k: grams(w) for k, w in real.items() if len(w) >= 5}
    df = Counter(g for c in long_.values() for g in c)
    weight = lambda g: 1 + math.log(len(long_)) - math.log(df.get(g, 1))
    want = {}
    for n, t in rows:
        w = tokens(t)
        for k, own in real.items():
            best = 0
            for a in range(len(w) - len(own) + 1):
                if len(own) < 5:
                    best = max(best, float(w[a : a + len(own)] == own))
                    continue
                c = grams(w[a : a + len(own)])
                if not c.keys() & long_[k].keys():
                    continue
                both = c.keys() | long_[k].keys()
                best = max(best, sum(weight(g) * min(c[g], long_[k][g]) for g in both) / sum(weight(g) * max(c[g], long_[k][g]) for g in both))
            if best >= 0.8 - 1e-9:
                want[n, k] = round(best, 6)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): round(x["similarity"], 6) for x in decontaminate.find(docs, bench).collect()}
    assert len(want) > 30 and got == want
    assert {(x["doc_id"], x["item_id"]) for x in decontaminate.find(docs, bench, item_block=7).select("doc_id", "item_id").collect()} >= {k for k in want if want[k] == 1}
    kept = {x["doc_id"] for x in decontaminate.decontaminate(docs, bench).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _ in want}
    assert decontaminate.find(docs.limit(0), bench).count() == 0 and decontaminate.find(docs, bench.limit(0)).count() == 0


def test_decontamination_of_documents_shorter_than_the_item(spark):
    r = random.Random(6)
    w = [r.choice(VOCAB) for _ in range(60)]
    rows = [(1, " ".join(w[:58])), (2, " ".join(w[3:])), (3, " ".join(w[:30])), (4, " ".join(w[:4])), (5, "x " * 9 + " ".join(w))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(w))], "item_id long, text string")
    got = sorted((x["doc_id"], round(x["similarity"], 6), x["first_word"], x["n_words"]) for x in decontaminate.find(docs, bench).collect())
    assert got == [(1, round(54 / 56, 6), 0, 58), (2, round(53 / 56, 6), 0, 57), (5, 1.0, 9, 60)]


def test_decontamination_in_blocks_equals_one_block(spark):
    r = random.Random(8)
    lead = [[r.choice(VOCAB) for _ in range(14)] for _ in range(3)]  # items share passages, so their weights differ
    items = [(k, " ".join(lead[k % 3] + [r.choice(VOCAB) for _ in range(r.randint(14, 30))])) for k in range(30)] + [(90, "too short"), (None, "w1 w2 w3 w4 w5 w6")]
    rows = []
    for n in range(90):
        w = items[n % 30][1].split()
        for _ in range(n // 30):
            w[r.randrange(len(w))] = "changed"
        rows.append((n, " ".join(["w5"] * (n % 4) + w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one, blocks = (sorted((x["doc_id"], x["item_id"], round(x["similarity"], 9), x["first_word"]) for x in decontaminate.find(docs, bench, item_block=size).collect()) for size in (20_000, 7))
    assert len(one) > 30 and any(x[2] < 1 for x in one) and blocks == one


def test_block_neighbours_find_all_fingerprints_in_the_radius():
    """Two fingerprints within the radius agree on a block up to what the look-up allows for."""
    r = random.Random(4)
    for _ in range(300):
        a = r.getrandbits(decontaminate.BITS)
        b = a
        for k in r.sample(range(decontaminate.BITS), decontaminate.RADIUS):
            b ^= 1 << k
        blocks = [(x >> (8 * k)) & 255 for x in (a, b) for k in range(decontaminate.BLOCKS)]
        assert any(p ^ q in decontaminate._NEAR for p, q in zip(blocks[:16], blocks[16:]))


def test_pipeline_stages(spark):
    """Whole run: toxic, repeated, leaked rows go; what is left is packed without loss."""
    import corpus_pipeline as p

    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        rows = out.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        seen.append((name, {r["doc_id"]: r["text"] for r in rows}))
    assert [n for n, _ in seen] == ["toxicity", "line_dedup", "ngram_jaccard", "decontamination"]
    clean, lines, single, last = (s for _, s in seen)
    gone = brute_lines(list(clean.items()))
    assert lines == {i: t if i not in gone else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i]) for i, t in clean.items()}
    keep = {i for i, n, c in brute_components(list(lines.items()), 5, 80) if i == c}
    assert {str(i) for i in single} == keep
    assert set(last) <= set(single) and len(last) >= 0.9 * len(single)
    pieces = p.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in pieces} == set(last)
    assert sum(r["length"] for r in pieces) == sum({r["doc_id"]: r["doc_tokens"] for r in pieces}.values())


def _pipeline_tables(spark, path, docs):
    docs.write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert p.run(spark, _pipeline_tables(spark, tmp_path, docs)).collect() == []


def test_pipeline_with_nulls_long_texts_and_extra_columns(spark, tmp_path):
    """Documents without text or id stay; of two long texts that only differ in line breaks one does."""
    import corpus_pipeline as p

    long = " ".join(f"word{k}" for k in range(60_000))
    rows = [(9001, None, None, None, None, "x"), (9002, "", "en", "s", 0, "x"), (None, "a text of no id at all here", "en", "s", 1, "x"), (9003, long, "en", "s", 1, None), (9004, re.sub(r"((?:\S+ ){7})", r"\1\n", long) + " more", "en", "s", 1, None), (9005, "\n\n", None, "s", 2, "x")]
    own = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, component_id string")
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("component_id", F.lit("y"))
    out = p.run(spark, _pipeline_tables(spark, tmp_path, docs.unionByName(own))).collect()
    ids = {r["doc_id"] for r in out}
    assert {9001, 9002, None, 9003, 9005} <= ids and 9004 not in ids


def test_driver_holds_tables_packed(spark):
    """The driver passes on compressed parts; what tasks unpack has the counts and the wanted nodes."""
    import pickle

    import pyarrow as pa

    from sigilgraph.llm import rarity, setjoin, text

    docs = spark.createDataFrame([(k, f"all w{k} some{k % 3}") for k in range(40)], "doc_id long, text string")
    table = rarity.rarity_table(docs)
    words = lambda *w: rarity.slot(text.word_hashes(*text.buffers(pa.array(w)))[0])
    assert len(pickle.dumps(table)) < 1 << 20
    codes = pickle.loads(pickle.dumps(table)).array()
    assert len(codes) == rarity.SLOTS and (codes > 0).sum() == len(set(words("all", "some0", "some1", "some2", *(f"w{k}" for k in range(40)))))
    assert codes[words("w7", "all", "none")].tolist() == [1, 2 + int(4 * np.log2(40)), 0]
    bits = setjoin.node_filter(spark.createDataFrame([(3, 5), (7, None)], "q long, c long"))
    assert len(pickle.dumps(bits)) < 1 << 20
    assert setjoin.wanted(pickle.loads(pickle.dumps(bits)), np.array([3, 4, 5, 7, 9])).tolist() == [True, False, True, True, False]
