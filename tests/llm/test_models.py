"""Learned operators: held-out accuracy, whole texts, edge cases."""

import zlib

import corpus_pipeline
import numpy as np
import pyarrow as pa

from sigilgraph.llm import langid, queries, secrets, toxicity

SF = "/root/testdata/sf0.01"
ODD = "doc_id long, text string, score string"


def test_language_held_out_accuracy(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op3_language_id(spark, SF).collect()
    assert len(got) == len(docs)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]) > 0.97


def test_language_edges(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, "123 !!", "a"), (4, "le monde est grand " * 3, "a"), (None, "hello", "a")], ODD)
    rows = spark.createDataFrame([(i, t, lang) for i in range(40) for t, lang in ((f"le monde est grand et la mer {i}", "fr"), (f"the world is big and the sea {i}", "en"))], "doc_id long, text string, lang string")
    model = langid.fit(rows, clusters=3)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, model, reject=False).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] == "fr" and got[None][0] in ("fr", "en")
    far = spark.createDataFrame([(1, "zxqj " * 50, "")], ODD)
    assert langid.predict(far, model).first()["lang_pred"] == "und"
    assert langid.fit(rows.limit(0)) is None and langid.predict(docs, None).first()["lang_pred"] == "und"
    assert langid.predict(docs.limit(0), model).count() == 0


def test_toxicity_held_out(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = queries.op6_toxicity(spark, SF).collect()
    assert len(got) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    held = [(r["score"], labels[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in labels]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert auc > 0.8
    assert np.mean([s >= 0.7 for s in neg]) < 0.02


def test_forward_backward_equals_enumeration():
    r = np.random.default_rng(0)
    e, begins = r.normal(0, 2, 12), np.zeros(12, bool)
    begins[[0, 5, 6]] = True
    m = toxicity.Field(transitions=r.normal(0, 1, (2, 2)), start=r.normal(0, 1, 2))
    p, xi = toxicity.forward_backward(e, begins, m, pairs=True)
    z, want, pair = 0.0, np.zeros(12), np.zeros((2, 2))
    for code in range(1 << 12):
        y = [(code >> t) & 1 for t in range(12)]
        s = sum(e[t] * y[t] + (m.start[y[t]] if begins[t] else m.transitions[y[t - 1], y[t]]) for t in range(12))
        w = np.exp(s)
        z += w
        want += w * np.array(y)
        for t in range(12):
            if not begins[t]:
                pair[y[t - 1], y[t]] += w
    assert np.allclose(p, want / z) and np.allclose(xi, pair / z)


def test_toxicity_spans_and_edges(spark):
    texts = pa.array(["you IDIOT here fool", "all is well"] * 30, pa.large_string())
    model = toxicity.fit(texts, np.array([True, False] * 30))
    docs = spark.createDataFrame([(1, "ünï you idiot here", ""), (2, None, ""), (3, "", ""), (None, "all is well", ""), (4, "x " * 5000 + "idiot", "")], ODD)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert [(s["start"], s["end"]) for s in got[1]["spans"] if s["start"] == 8] == [(8, 13)]
    assert got[2]["score"] == got[3]["score"] < got[1]["score"] and got[4]["spans"][-1]["end"] == 10005
    assert toxicity.fit(texts[:0], np.zeros(0, bool)).curve is None
    assert toxicity.score(docs, toxicity.Field()).where("score = 0").count() == 5 and toxicity.score(docs.limit(0), model).count() == 0
    assert {r["doc_id"] for r in toxicity.keep_clean(docs, model, 0.7).collect()} == {i for i, r in got.items() if r["score"] < 0.7}


def brute_candidates(text):
    """Spans (in characters) of assigned values and of long runs outside of them."""
    import re

    t, spans = (text or "").encode() + b"\n", []
    for m in re.finditer(rb"(?<![:=\n/ \t\"'])[ \t\"']*[:=][ \t]*[\"']?([^\s\"'`,;]{6,})", t):
        spans.append(m.span(1))
    for m in re.finditer(rb"[A-Za-z0-9+/_-]{16,}", t):
        if (re.search(rb"\d", m.group()) or len(m.group()) >= 20) and not any(a < m.end() and m.start() < z for a, z in spans):
            spans.append(m.span())
    return {(len(t[:a].decode()), len(t[:z].decode())) for a, z in spans}


def test_secret_scan(spark):
    import re

    got = queries.op8_secret_scan(spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {(r["doc_id"], r["start"], r["end"]) for r in got} == {(i, a, z) for i, t in docs.items() for a, z in brute_candidates(t)}
    real = {(i, m.start(1), m.end(1)) for i, t in docs.items() for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', t)}
    assert real and {(r["doc_id"], r["start"], r["end"]) for r in got if r["is_secret"]} == real


def test_secret_edges(spark):
    docs = spark.createDataFrame([(1, None, ""), (2, "", ""), (3, "é password: 'abcdefgh12345678ZZ'", ""), (None, "id 0123456789abcdef", ""), (5, "0123456789ab", ""), (6, "cdef456", ""), (7, "pwd = hunter2! é", ""), (8, "q" * 25, ""), (9, "see http://a.b/c", ""), (10, "= 1234567", "")], ODD)
    found = secrets.candidates(docs)
    rows = {r["doc_id"]: (r["start"], r["end"], r["candidate"]) for r in found.collect()}
    assert rows == {3: (13, 31, "abcdefgh12345678ZZ"), None: (3, 19, "0123456789abcdef"), 7: (6, 14, "hunter2!"), 8: (0, 25, "q" * 25), 9: (9, 16, "//a.b/c")}
    assert all(len(r["x"]) == len(secrets.FEATURES) for r in found.collect())
    assert secrets.train_forest(secrets.assigned_findings(found, found["doc_id"] == 3)) is None
    assert {r["is_secret"] for r in secrets.scan(found, None).collect()} == {True}
    assert secrets.candidates(docs.limit(0)).count() == 0


def test_transitions_do_not_depend_on_partitions(spark):
    rows = [(k, t, "") for k, t in enumerate(["ab"] * 20 + ["", None, "a", "é", "xy\nab"])]
    one, many = (secrets.transitions(spark.createDataFrame(rows, ODD).repartition(n)) for n in (1, 20))
    assert (one == many).all() and one[98, 97] == one[98, 98]  # no text has an a after b


def test_toxicity_learns_from_bounded_texts(spark):
    docs = spark.createDataFrame([(k, "w " * (k + 1), "") for k in range(20)], ODD)
    labels = spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id long, toxic int")
    texts, toxic = toxicity.training_texts(docs, labels, 20)
    assert len(texts) == 20 and toxic.sum() == 10
    texts, toxic = toxicity.training_texts(docs, labels, 20, longest=20)
    assert sorted(map(len, texts.to_pylist())) == [2 * (k + 1) for k in range(10)]
    texts, toxic = toxicity.training_texts(docs, labels, 20, most_bytes=60)
    assert all(sum(len(t) for t, x in zip(texts.to_pylist(), toxic) if x == c) <= 30 for c in (True, False)) and 0 < len(texts) < 20


def test_toxicity_learns_in_a_task(spark, monkeypatch):
    """The pipeline's and the query's training texts stay off the driver; the field is the one that these texts give."""
    docs = spark.createDataFrame([(k, f"you see an {'idiot' if k % 2 else 'apple'} here id now", "") for k in range(60)], ODD)
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    plain = toxicity.fit(*toxicity.training_texts(docs, labels, 50))

    def none(*_, **__):
        raise AssertionError("training texts on the driver")

    monkeypatch.setattr(toxicity, "training_texts", none)
    model = toxicity.train(docs, labels, 50)
    assert model.curve is not None and (model.weights == plain.weights).all() and (model.curve == plain.curve).all()
    assert toxicity.train(docs, labels.limit(0)).curve is None and toxicity.train(docs.limit(0), labels).base == 0
    assert queries.op6_toxicity(spark, "/root/testdata/sf0.001").count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    kept = corpus_pipeline.drop_toxic(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "/root/testdata/sf0.001")
    assert kept.count() > 0


def test_secret_features_do_not_name_the_label(spark):
    """The same value has the same features whatever the name is that it is assigned to."""
    docs = spark.createDataFrame([(k, f'was {name} = "0a1b2c3d4e5f6a7b8c9d" there', "") for k, name in enumerate(["token", "colour", "secret"])], ODD)
    assert len({tuple(r["x"]) for r in secrets.candidates(docs).collect()}) == 1


def test_long_texts_take_linear_time(spark):
    """Half a million characters with a finding every few words."""
    import time

    start = time.time()
    docs = spark.createDataFrame([(1, "é idiot id 0123456789abcdef " * 20_000, "")], ODD)
    found = secrets.candidates(docs.select("doc_id", "text"))
    assert found.where("candidate = '0123456789abcdef' and start % 28 = 11").count() == 20_000
    model = toxicity.fit(pa.array(["you see an idiot here id now", "you see an apple here id now"] * 30, pa.large_string()), np.array([True, False] * 30))
    spans = toxicity.score(docs, model).first()["spans"]
    assert len(spans) == 20_000 and spans[-1]["end"] == 19_999 * 28 + 7
    assert time.time() - start < 60


def test_every_language_is_learned(spark):
    rows = [(i, f"{chr(97 + k // 26)}{chr(97 + k % 26)} " * 9, f"l{k:03}") for k in range(230) for i in range(k * 3, k * 3 + 3)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), clusters=1)
    assert len(set(model.languages)) == 230
