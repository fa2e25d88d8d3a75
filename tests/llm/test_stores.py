"""Token store, packing, chat and top-k: exact round trips, brute force and edge cases."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from sigilgraph.llm import chat, packing, token_store, topk
from sigilgraph.llm.tokenize import encoder, tokenizer_path
from sigilgraph.session import scratch_path

TEXTS = ["", None, " ", "a  b \n\n c", "x<|endoftext|>y", "it's I'LL don't 123 4½ ²", "中文 text ΑΣ", "Ünï ŸĞİ İx é", "é", "a\xa0b", "tab\tx\r\n  y", "'s 's's", "word " * 3000]


def ids_of(name):
    t = Tokenizer.from_file(tokenizer_path(name))
    return lambda x: np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_tokenizer(name):
    e, real = encoder(tokenizer_path(name)), ids_of(name)
    for x in TEXTS:
        assert e.ids(x or "").tolist() == real(x)[:-1].tolist()


ODD_PARTS = ["a", "b", "s", "t", "re", "ll", "d", " ", "  ", "\n", "\t", "'", "''", "1", "23", "²", "é", "É", "ß", "œ", ".", "-", "–", "“", "…", "<|endoftext|>", "<|ENDOFTEXT|>", "中", "Σ", "İ", "e\u0301", "\xa0", "\x1c", "\x00", "😀", "ª", "'S", "\u200b"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_columns_equal_tokenizer(name):
    """Random texts, with and without characters that are left to the tokenizer, in one column."""
    r = random.Random(1)
    texts = ["".join(r.choice(ODD_PARTS[: r.choice([16, 25, 99])]) for _ in range(r.randint(0, 30))) for _ in range(2500)] + [None, "", "long" * 30, " " * 900 + "b"]
    e = encoder(tokenizer_path(name))
    ids, at = e.column(pa.array(texts, pa.large_string()), 2)
    real = [x.ids + [2] for x in e.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:])] == real


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_on_documents(name, monkeypatch):
    """All texts of a table, with a table of pre-tokens that is too small and so is emptied again and again."""
    from sigilgraph.llm import tokenize

    monkeypatch.setattr(tokenize, "SLOT_BITS", 13)
    monkeypatch.setattr(tokenize, "SLOTS", 1 << 13)
    monkeypatch.setattr(tokenize, "PIECES", 1 << 11)
    e = tokenize.Encoder(tokenizer_path(name))
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").combine_chunks()
    ids, at = e.column(texts, 2)
    real = [x.ids + [2] for x in e.tokenizer.encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
    assert [zlib.crc32(ids[i:j].tobytes()) for i, j in zip(at[:-1], at[1:])] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in real]


def test_encoder_refuses_other_kinds():
    from sigilgraph.llm.tokenize import Encoder

    with pytest.raises(ValueError):
        Encoder._is_lower({"pre_tokenizer": {"type": "Whitespace"}, "normalizer": None})


def test_token_store_round_trip(spark):
    real = ids_of("byte_bpe_50k.json")
    rows = [(i * 3, t) for i, t in enumerate(TEXTS)] + [(6, "again"), (6, "again"), (None, "no id")]
    path = scratch_path(spark, "t")
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, start string")
    token_store.write_store(docs, path, tokenizer_path("byte_bpe_50k.json"), shards=3)
    got = sorted(token_store.read_store(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert sorted((r["doc_id"], tuple(np.array(r["ids"], "<u4"))) for r in got if r["doc_id"] is not None) == sorted((i, tuple(real(t))) for i, t in rows if i is not None)
    at = 0
    for r in got:
        ids = np.array(r["ids"], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    one = token_store.read_store(spark, path, doc_id=9).collect()
    assert [tuple(r["ids"]) for r in one] == [tuple(real(TEXTS[3]))]


def test_token_store_with_dictionary(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    path = scratch_path(spark, "t")
    token_store.write_store(docs, path, tokenizer_path("byte_bpe_50k.json"), dict_bytes=4096)
    assert len(spark.read.parquet(f"{path}/dictionary").first()["dictionary"]) > 1000
    real = ids_of("byte_bpe_50k.json")
    want = {r["doc_id"]: zlib.crc32(real(r["text"]).tobytes()) for r in docs.collect()}
    assert {r["doc_id"]: r["ids_crc32"] for r in token_store.read_store(spark, path, with_ids=False).collect()} == want


def test_token_store_empty(spark):
    path = scratch_path(spark, "t")
    token_store.write_store(spark.createDataFrame([], "doc_id long, text string"), path, tokenizer_path("byte_bpe_50k.json"))
    assert token_store.read_store(spark, path).count() == 0


def test_packing(spark):
    real = ids_of("word_bpe_49k.json")
    rows = list(enumerate(TEXTS)) + [(20, "same " * 50), (20, "other " * 50), (21, "long text here " * 9000)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, key int")
    got = packing.pack(docs, tokenizer_path("word_bpe_49k.json"), partitions=3).collect()
    by_seq = {}
    for r in got:
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == r["length"] and zlib.crc32(ids.tobytes()) == r["ids_crc32"]
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 4096 and at & (at - 1) == 0
    whole = {}
    for r in sorted(got, key=lambda r: r["start"]):
        if r["doc_id"] != 20:
            whole.setdefault(r["doc_id"], []).append(np.frombuffer(bytes(r["ids"]), "<u4"))
    for i, t in rows:
        if i != 20:
            assert np.concatenate(whole[i]).tolist() == real(t).tolist()
    assert packing.pack(docs.limit(0), tokenizer_path("word_bpe_49k.json")).count() == 0


def test_hilbert_neighbours():
    """Consecutive keys are neighbouring points, and every point has its own key."""
    side = np.array(np.meshgrid(*[range(8)] * 3)).reshape(3, -1).T
    key = packing.hilbert_key(side, bits=3)
    assert sorted(key) == list(range(512))
    assert (np.abs(np.diff(side[np.argsort(key)], axis=0)).sum(1) == 1).all()


def fold(events):
    text, role = {}, {}
    for seq, event, message, who, t in events:
        role.setdefault(message, who)
        if event == "delta":
            text[message] = text.get(message, "") + (t or "")
        else:
            text[message] = t or ""
    return text, role


def test_chat_events_fold(spark):
    r = random.Random(3)
    rows, want = [], {}
    for conv in range(8):
        events = []
        for seq in range(60):
            m = r.randint(0, 5)
            events.append((seq, r.choice(["delta", "delta", "delta", "edit", "regenerate", "message"]), m, "assistant" if m % 2 else "user", r.choice(["x", "</turn>", "\\l", "###", None, ":"])))
        want[conv] = fold(events)
        rows += [(conv, *e) for e in events]
    r.shuffle(rows)
    log = spark.createDataFrame(rows, "conv_id long, seq long, event string, message long, role string, text string")
    for x in chat.fold_events(log).collect():
        text, role = want[x["conv_id"]]
        assert x["text"] == text[x["message"]] and x["role"] == role[x["message"]]
    plan = chat.render(chat.fold_events(log))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_chat_round_trip(spark):
    said = ["\\### Assistant: </turn> ok", None, "", "a\\b#h<l:c", "### user: x</turn>\n", "ünï\n\n"]
    rows = [(c, t, r, x) for c in (1, 2, None) for t, (r, x) in enumerate([(r, x) for r in ("user", "assistant", "sy:s", None) for x in said])]
    rows += [(5, 0, "assistant", "x"), (5, 0, "assistant", "x"), (6, None, "assistant", None)]
    told = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parsed = chat.parse(chat.render(chat.fold_events(chat.from_turns(told))))
    for x in parsed.collect():
        own = [(r or "", t or "") for c, n, r, t in rows if c == x["conv_id"]]
        assert [(t["role"], t["text"]) for t in x["turns"]] == own
        assert x["loss_texts"] == [t for r, t in own if r == "assistant"]
    for x in chat.digests(parsed).collect():
        own = [(r or "", t or "") for c, n, r, t in rows if c == x["conv_id"]]
        assert x["n_turns"] == len(own)
        assert x["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert x["loss_sha256"] == hashlib.sha256("".join(t for r, t in own if r == "assistant").encode()).hexdigest()
    assert chat.digests(chat.parse(chat.render(chat.fold_events(chat.from_turns(told.limit(0)))))).count() == 0


@pytest.mark.parametrize("k,block", [(5, 20_000), (3, 17)])
def test_topk_equals_brute_force(spark, k, block):
    r = np.random.default_rng(1)
    x = r.normal(0, 0.2, (700, 12)).round(2)
    x[200:420] = x[5]  # a group of copies, so ties
    rows = [(int(i), v.tolist(), 0) for i, v in enumerate(x)] + [(900, [3.0] * 12, 0), (900, [2.0] * 12, 0), (800, None, 0), (801, [1.0, None], 0), (802, [float("nan")] * 12, 0), (803, [], 0), (None, [1.0] * 12, 0), (805, [0.5, 0.25], 0), (10, x[10].tolist(), 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    vectors = topk.integer_vectors(table)
    got = topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k, pivots=7, sample=100, query_block=block).collect()
    v = {}
    full = []
    for i, e, _ in rows:
        if i is not None and e and all(z is not None and np.isfinite(z) for z in e):
            z = np.zeros(12, np.int64)
            z[: len(e)] = np.floor(np.array(e, np.float32).astype(np.float64) * 256)
            full.append((i, z))
            v[i] = min(v.get(i, z), z, key=tuple)  # a repeated id asks with its least vector
    want = []
    for q in v:
        if q % 50 == 0:
            s = sorted((-int(v[q] @ z), i) for i, z in full if i != q)[:k]
            want += [(q, n + 1, i, -a) for n, (a, i) in enumerate(s)]
    assert sorted(tuple(x) for x in got) == sorted(want)
    huge = topk.integer_vectors(spark.createDataFrame([(50, [1e30, 1.0]), (51, [2e30, 0.0]), (52, [0.0, 1.0])], "vec_id long, embedding array<float>"))
    assert [r["vec_id"] for r in topk.top_k(huge, huge.where("vec_id = 50"), 5).orderBy("rank").collect()] == [51, 52]
    assert topk.top_k(vectors.limit(0), vectors, k).count() == 0 and topk.top_k(vectors, vectors.limit(0), k).count() == 0
