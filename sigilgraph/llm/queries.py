"""The thin queries of this subpackage's operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import make_importable, scratch_path, small_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    make_importable(spark)
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_store import read_store, write_store
    from .tokenize import tokenizer_path

    path = scratch_path(spark, "token-store")
    write_store(table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"))
    return read_store(spark, path, with_ids=False)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack
    from .tokenize import tokenizer_path

    return pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), with_ids=False)


TOXIC_AT = 0.7


def _fold(n: int):
    """crc32 of doc_id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def train_rows(labels: DataFrame) -> DataFrame:
    """Labels that toxicity may learn from."""
    return labels.where(_fold(3) != 1)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import similar_documents

    return similar_documents(table(spark, sf_dir, "documents"), shingle=4, percent=85)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import langid

    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(_fold(4) != 2))
    out = langid.predict(docs, model, reject=False)
    return out.select("doc_id", F.coalesce(_fold(4) == 2, F.lit(True)).alias("held_out"), "lang_pred", "score", "rejected")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import find

    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, train_rows(table(spark, sf_dir, "labels")))
    out = toxicity.score(docs, model)
    return out.select("doc_id", F.coalesce(_fold(3) == 1, F.lit(True)).alias("held_out"), "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"), F.size("spans").alias("n_spans"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import counts

    return counts(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..session import materialize
    from . import secrets

    found = materialize(secrets.candidates(table(spark, sf_dir, "documents")), "secret-candidates")
    forest = secrets.train_forest(secrets.assigned_findings(found, _fold(4) != 2))
    return secrets.scan(found, forest)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import chat

    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.parse(chat.render(chat.fold_events(chat.from_turns(rows)))))


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import integer_vectors, top_k

    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import bpe
    from .tokenize import tokenizer_path

    path = tokenizer_path("byte_bpe_50k.json")
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import fim

    return fim.restore(fim.transform(table(spark, sf_dir, "documents")), with_text=False)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import spelling

    words = spelling.misspelt(spelling.runs(table(spark, sf_dir, "documents"), 7))
    return spelling.variants(spelling.counted(words, 7, 2))


QUERIES = {
    "op1_token_store": op1_token_store,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_language_id": op3_language_id,
    "op4_decontamination": op4_decontamination,
    "op5_chat_format": op5_chat_format,
    "op6_toxicity": op6_toxicity,
    "op7_line_dedup": op7_line_dedup,
    "op8_secret_scan": op8_secret_scan,
    "op9_packing": op9_packing,
    "op10_exact_topk": op10_exact_topk,
    "op11_bpe": op11_bpe,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": pipeline,
}

SQL: dict[str, str] = {
    "op5_chat_format": r"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM rows),
e AS (SELECT *, replace(replace(replace(text, '\', '\b'), '#', '\h'), '<', '\l') AS body,
        replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c') AS head FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, body), '')) AS loss_sha256,
  sum(length(head) + length(body) + 14)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",
    "op10_exact_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v)::BIGINT AS score
  FROM v q JOIN v x ON q.vec_id % 50 = 0 AND q.vec_id <> x.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op12_fill_in_middle": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
h AS (SELECT *, length(text) AS n, ('0x' || substr(h, 1, 8))::UBIGINT AS h1, ('0x' || substr(h, 9, 8))::UBIGINT AS h2,
        ('0x' || substr(h, 17, 8))::UBIGINT AS h3, ('0x' || substr(h, 25, 8))::UBIGINT AS h4 FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS a, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS z,
        CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
o AS (SELECT *, CASE form WHEN 'plain' THEN text
        WHEN 'psm' THEN '<P>' || substr(text, 1, a) || '<S>' || substr(text, z + 1) || '<M>' || substr(text, a + 1, z - a)
        ELSE '<S>' || substr(text, z + 1) || '<P>' || substr(text, 1, a) || '<M>' || substr(text, a + 1, z - a) END AS output FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN z - a END AS middle_chars,
  sha256(output) AS output_sha256, sha256(text) AS restored_sha256 FROM o""",
    # crc32 by its table of 256 remainders, which is made from the polynomial.
    "op13_spelling_variants": r"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
r AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
k AS (SELECT doc_id, run, count(*) AS times, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS hex FROM r GROUP BY doc_id, run),
h AS (SELECT run, times, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(hex), 2), lambda i: ('0x' || hex[i + 1:i + 2])::BIGINT)),
        lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) AS h FROM k, crc),
w AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM h),
words AS MATERIALIZED (SELECT word, sum(times)::BIGINT AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
d AS (SELECT DISTINCT word, substr(word, 1, i - 1) || substr(word, i + 1) AS key FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
e AS MATERIALIZED (SELECT word, word AS key FROM words UNION ALL SELECT * FROM d),
near AS MATERIALIZED (SELECT DISTINCT a.word, b.word AS other FROM e a JOIN e b ON a.key = b.key AND a.word <> b.word
  WHERE length(a.word) <> length(b.word)
    OR len(list_filter(list_zip(regexp_extract_all(a.word, '.'), regexp_extract_all(b.word, '.')), lambda p: p[1] <> p[2])) = 1),
best AS (SELECT near.word, count(*) AS n_near, arg_min(near.other, (-o.n, near.other)) AS other, max(o.n) AS other_n FROM near JOIN words o ON o.word = near.other GROUP BY near.word),
f AS MATERIALIZED (SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root, 0 AS step FROM f UNION ALL SELECT chain.word, f.form, step + 1 FROM chain JOIN f ON f.word = chain.root WHERE f.form IS NOT NULL)
SELECT f.word, form, arg_max(chain.root, step) AS root, n, n_near, form_n FROM f JOIN chain USING (word) GROUP BY f.word, form, n, n_near, form_n""",
}
