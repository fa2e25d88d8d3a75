"""Byte-pair encoding, fill-in-middle and spelling variants: the library, plain Python and edge cases."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sigilgraph.llm import bpe, fim, queries, spelling
from sigilgraph.llm.tokenize import tokenizer_path

ODD = ["a", "b", "s", "t", "re", "ll", "d", " ", "  ", "\n", "'", "''", "1", "23", "é", "ß", ".", "–", "<|endoftext|>", "<|ENDOFTEXT|>", "中", "Σ", "é", "\xa0", "\x1c", "\x00", "😀", "​", "՘", "\U0002ebf0", "<P>", "<S", ">", "<M>"]
TEXTS = ["", None, " ", "x<|endoftext|>y", "<|endoftext|>", "aaaaaaa" * 500, "\n" * 300, "añ" * 20_000, "q" * 300 + " z" * 3000]


def odd_texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(ODD[: r.choice([16, 22, 99])]) for _ in range(r.randint(0, 30))) for _ in range(n)] + TEXTS


def test_bpe_equals_library():
    c = bpe.codec(tokenizer_path("byte_bpe_50k.json"))
    texts = odd_texts(3000, 3)
    ids, begin = c.column(pa.array(texts, pa.large_string()))
    real = [x.ids for x in c.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [ids[i:j].tolist() for i, j in zip(begin[:-1], begin[1:])] == real
    assert [c._whole(t or "").tolist() for t in texts] == real
    raw, at = c.decode(ids, begin)
    assert [raw[i:j].tobytes().decode() for i, j in zip(at[:-1], at[1:])] == [t or "" for t in texts]


def test_bpe_decodes_any_ids():
    c, r = bpe.codec(tokenizer_path("byte_bpe_50k.json")), random.Random(4)
    for _ in range(1000):
        ids = [r.randrange(50257) for _ in range(r.randint(0, 6))]
        raw, _ = c.decode(np.array(ids, np.uint32), np.array([0, len(ids)]))
        assert raw.tobytes().decode("utf-8", "replace") == c.tokenizer.decode(ids, skip_special_tokens=False)
    assert c.decode(np.array([60_000], np.uint32), np.array([0, 1]))[1].tolist() == [0, 0]


def test_bpe_refuses_other_kinds():
    with pytest.raises(ValueError):
        bpe.Codec(tokenizer_path("word_bpe_49k.json"))


def test_bpe_rows(spark, monkeypatch):
    c = bpe.codec(tokenizer_path("byte_bpe_50k.json"))
    rows = list(enumerate(odd_texts(200, 5))) + [(3, "again"), (3, "again"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, ids string, decoded int").repartition(5)
    out = bpe.decode(bpe.encode(docs, tokenizer_path("byte_bpe_50k.json")), tokenizer_path("byte_bpe_50k.json"))
    got = Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in out.collect())
    real = [c.tokenizer.encode(t or "", add_special_tokens=False).ids for _, t in rows]
    assert got == Counter((i, len(x), np.array(x, "<u4").tobytes(), t or "") for (i, t), x in zip(rows, real))
    digest = {r["doc_id"]: r for r in bpe.digests(out).collect()}
    assert digest[0]["ids_sha256"] == hashlib.sha256(np.array(real[0], "<u4").tobytes()).hexdigest()
    half = np.array(c.tokenizer.encode("😀", add_special_tokens=False).ids[:1], "<u4").tobytes()
    cut = spark.createDataFrame([(1, 1, bytearray(half)), (2, 0, None)], "doc_id long, n_tokens long, ids binary")
    assert [r["decoded"] for r in bpe.decode(cut, tokenizer_path("byte_bpe_50k.json")).orderBy("doc_id").collect()] == ["\ufffd", ""]
    assert bpe.digests(bpe.decode(bpe.encode(docs.limit(0), tokenizer_path("byte_bpe_50k.json")), tokenizer_path("byte_bpe_50k.json"))).collect() == []


def middle(i, text):
    """A document's row in plain Python."""
    x = text or ""
    n, d = len(x), hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, z = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not x or any(m in x for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (i, n, "plain", None, None, x, x)
    if h[3] % 100 < 20:
        return (i, n, "spm", a, z - a, f"<S>{x[z:]}<P>{x[:a]}<M>{x[a:z]}", x)
    return (i, n, "psm", a, z - a, f"<P>{x[:a]}<S>{x[z:]}<M>{x[a:z]}", x)


def test_fill_in_middle(spark, monkeypatch):
    r = random.Random(6)
    sizes = ["".join(r.choice("aé中😀\n\x00 <PSM>") for _ in range(n)) for n in (1, 2, 63, 64, 65, 127, 128, 129, 640, 5000) for _ in range(40)]
    rows = list(enumerate(odd_texts(300, 7) + sizes)) + [(3, "again"), (3, "again"), (None, "no id"), (-5, "less")]
    monkeypatch.setattr(fim, "TEXT_BYTES", 2000)
    docs = spark.createDataFrame([(t, i, "x") for i, t in rows], "text string, doc_id long, form string").repartition(3)
    got = fim.restore(fim.transform(docs)).collect()
    want = Counter(middle(i, t) for i, t in rows)
    assert Counter((g["doc_id"], g["n"], g["form"], g["prefix_chars"], g["middle_chars"], g["output"], g["restored"]) for g in got) == want
    assert {g["form"] for g in got} == {"plain", "psm", "spm"}
    for g in got:
        assert g["output_sha256"] == hashlib.sha256(g["output"].encode()).hexdigest() and g["restored_sha256"] == hashlib.sha256(g["restored"].encode()).hexdigest()
    assert fim.restore(fim.transform(docs.limit(0)), with_text=False).collect() == []
    assert {g["form"] for g in fim.transform(docs, percent=0).collect()} == {"plain"}


def apart(a, b):
    """Whether two words differ by one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts, times=10):
    best, out = {}, set()
    for w in counts:
        close = [v for v in counts if apart(w, v)]
        top = min(close, key=lambda v: (-counts[v], v), default=None)
        best[w] = (len(close), top if top is not None and counts[top] >= times * counts[w] else None)
    for w, n in counts.items():
        near, form = best[w]
        root = w
        while best[root][1] is not None:
            root = best[root][1]
        out.add((w, form, root, n, near, counts[form] if form else None))
    return out


@pytest.mark.parametrize("alphabet", ["ab", "aé😀", "abcdefghij"])
def test_variants_equal_brute_force(spark, alphabet):
    r = random.Random(len(alphabet))
    words = {"".join(r.choice(alphabet) for _ in range(r.randint(1, 9))) for _ in range(350)} | {"a" * 3000, "a" * 2999, "a" * 1500 + alphabet[1] + "a" * 1499}
    counts = {w: r.choice([2, 3, 20, 25, 200, 250, 3000, 40000]) for w in sorted(words)}
    order = sorted(counts, key=lambda w: (-counts[w], w))
    frame = spark.createDataFrame([(k, w, counts[w], "x") for k, w in enumerate(order)], "id long, word string, n long, root string").repartition(3)
    got = spelling.variants(frame).collect()
    assert {tuple(g[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for g in got} == brute_variants(counts) and len(got) == len(counts)


def brute_words(rows):
    import regex

    found = Counter()
    for i, text in rows:
        for run in regex.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def test_spelling_query(spark, tmp_path):
    r = random.Random(8)
    base = ["mountain", "Ähnlich", "FÉDÉRAL", "aaaaaaaa", "letters", "lettters", "×÷×÷×÷×÷"]
    texts = [" ".join(r.choice(base) * r.choice([1, 1, 1, 2]) if r.random() < 0.9 else r.choice(base)[1:] for _ in range(r.randint(0, 60))) + r.choice(["", "9", "_mountain-mountain"]) for _ in range(400)]
    rows = [(i % 380, t) for i, t in enumerate(texts)] + [(7, None), (None, "mountain Mountain"), (8, ""), (9, "abc" * 5000), (10, "abc" * 5000)]
    spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, run string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_spelling_variants(spark, str(tmp_path)).collect()
    assert {tuple(g[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for g in got} == brute_variants(brute_words(rows))
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert queries.op13_spelling_variants(spark, f"{tmp_path}/empty").collect() == []


def test_one_key_of_each_pair(spark):
    """Pairs come once, also words of equal letters and transposed ones that share keys but differ twice."""
    words = ["aaaaaaa", "aaaaaaaa", "aaaaaab", "ab", "ba", "abc", "acb", "b", ""]
    pairs = spelling.near(spark.createDataFrame(list(enumerate(words)), "id long, word string")).collect()
    got = Counter(frozenset((words[p["a"]], words[p["b"]])) for p in pairs)
    want = {frozenset((a, b)) for a in words for b in words if a < b and apart(a, b)}
    assert set(got) == want and set(got.values()) == {1}


def test_rings_are_refused(spark):
    with pytest.raises(RuntimeError):
        spelling.roots(spark.createDataFrame([(1, 2), (2, 1)], "id long, form long"), max_rounds=4)
