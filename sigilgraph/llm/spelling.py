"""Operator 13: spelling variants of a corpus, by a symmetric-delete join.

Every word emits a key for itself and for each distinct string that lacks one of its code points. Two words that differ by one
inserted, deleted or replaced code point share a key. A key is a 64-bit hash, so a word of n code points emits n + 1 short rows
whatever its length; the strings themselves stay in the table of words and decide at the end.

Words are numbered by falling count, equal counts by code points, so that the best of a word's neighbours is the one of least number.
As a word's form occurs several times as often as the word, chains of forms are short, and their roots are found by doubling.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import text as T

#: Runs of letters that are words: A-Z, a-z and U+00C0 to U+00FF.
LETTERS = "A-Za-zÀ-ÿ"
#: Bytes of words whose keys a task makes at once.
WORD_BYTES = 1 << 17
_BASE = T._P | np.uint64(1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def runs(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, run): each maximal run of at least ``least`` letters in the whole texts of ``docs`` (doc_id, text; others are
    ignored), A-Z lowered. A null text has none; repeated rows count each."""
    found = F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0)))
    upper = "".join(chr(c) for c in range(65, 91))
    return docs.select("doc_id", found.alias("run")).select("doc_id", F.translate("run", upper, upper.lower()).alias("run"))


def misspelt(found: DataFrame, every: int = 31) -> DataFrame:
    """(word) of ``runs``, where one in ``every`` runs of a document loses a code point, both picked by a hash of them."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    told = found.withColumn("h", h).withColumn("at", (F.col("h") % F.length("run")).cast("int"))
    cut = F.concat(F.substring("run", F.lit(1), F.col("at")), F.substring("run", F.col("at") + 2, F.length("run")))
    return told.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def counted(words: DataFrame, length: int, least: int) -> DataFrame:
    """(id, word, n): words of at least ``length`` code points that occur ``least`` times, numbered by falling n, then by code points."""
    known = words.where(F.length("word") >= length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    known = materialize(known, "words")
    return materialize(known.orderBy(F.desc("n"), "word").select(F.monotonically_increasing_id().alias("id"), "word", "n"), "numbered-words")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    power, inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)
    for batch in batches:
        for part in T.slices(batch, "word", WORD_BYTES):
            size = np.asarray(pc.utf8_length(part.column("word")), np.int64)
            ids = np.asarray(part.column("id"), np.int64)
            code = np.frombuffer("".join(part.column("word").to_pylist()).encode("utf-32-le"), "<u4")
            end = np.cumsum(size)
            begin, word = end - size, np.repeat(np.arange(len(size)), size)
            place = np.arange(len(code)) - begin[word]
            if size.max(initial=0) >= len(power):
                power = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(2 * int(size.max()), _BASE))])
            # Polynomials in the place: what is behind a dropped code point moves down by one power.
            term = T.fmix(code.astype(np.uint64) + T._SLOT[0]) * power[place]
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(term, dtype=np.uint64)])
            whole = total[end] - total[begin]
            rest = (total[end][word] - total[1:]) * _INVERSE + (total[:-1] - total[begin][word])
            # Dropping any code point of a run of equal ones gives the same string: the first stands for lo to hi.
            first = np.ones(len(code), bool)
            first[1:] = (code[1:] != code[:-1]) | (word[1:] != word[:-1])
            lo = np.flatnonzero(first)
            hi = np.append(lo[1:], len(code)) - 1
            own = T.fmix(whole + T.fmix(size.astype(np.uint64)))
            less = T.fmix(rest[lo] + T.fmix((size[word[lo]] - 1).astype(np.uint64)))
            key = np.concatenate([own, less]).view(np.int64)
            who = np.concatenate([ids, ids[word[lo]]])
            at = np.concatenate([np.full(len(size), -1), place[lo] << 32 | place[hi]])
            for k in range(0, len(key), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(x[k : k + (1 << 16)], pa.int64()) for x in (key, who, at)], names=["key", "id", "at"])


def keys(words: DataFrame) -> DataFrame:
    """(key, id, at) of words (id, word): the word's own key (at -1) and one of each distinct single deletion, with the first and the
    last place whose code point may be the missing one."""
    return words.select("id", "word").mapInArrow(_keys, "key long, id long, at long")


def near(words: DataFrame) -> DataFrame:
    """(a, b): ids of all pairs of ``words`` (id, word; words are distinct) that differ by exactly one inserted, deleted or replaced
    code point, each once, b being the longer or the later one.

    A key is shared by words of its length and a code point more: by no more than the alphabet times that many, whatever the corpus.
    Of two words that lack a code point the missing places must meet, which leaves one key a pair."""
    own = keys(words)
    x, y = own.select("key", F.col("id").alias("a"), F.col("at").alias("xa")), own.select("key", F.col("id").alias("b"), F.col("at").alias("ya"))
    lo, hi = lambda c: F.shiftright(c, 32), lambda c: F.col(c).bitwiseAND(0xFFFFFFFF)
    replaced = (F.col("xa") >= 0) & (F.col("a") < F.col("b")) & (lo("xa") <= hi("ya")) & (lo("ya") <= hi("xa"))
    pairs = x.join(y, "key").where((F.col("ya") >= 0) & ((F.col("xa") < 0) | replaced)).select("a", "b")
    # Keys are hashes: the words themselves are held against each other.
    told = pairs.join(words.select(F.col("id").alias("a"), F.col("word").alias("wa")), "a").join(words.select(F.col("id").alias("b"), F.col("word").alias("wb")), "b")
    return told.where(F.levenshtein("wa", "wb", 1) == 1).select("a", "b")


def roots(forms: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(id, root) of forms (id, form): where a chain of forms ends. Each round joins the chains with themselves, which halves what is
    left of them. Raises RuntimeError for chains that do not end, as of a ring."""
    found = materialize(forms.select("id", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    for _ in range(max_rounds):
        if not found.where("moved").limit(1).count():
            return found.drop("moved")
        further = found.select(F.col("id").alias("root"), F.col("root").alias("next"))
        found = materialize(found.join(further, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
    raise RuntimeError(f"forms did not end in {max_rounds} rounds")


def variants(words: DataFrame, times: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of words (id, word, n) as of ``counted``: the number of near words, the most frequent of them
    (ties: least in code points) if it occurs ``times`` as often as the word, and the word at the end of its chain of forms.

    A word without near words has n_near 0 and itself as root; without a form, form and form_n are null. Empty words give no rows."""
    pairs = near(words)
    both = pairs.select(F.col("a").alias("id"), F.col("b").alias("by")).unionByName(pairs.select(F.col("b").alias("id"), F.col("a").alias("by")))
    best = both.groupBy("id").agg(F.count("*").alias("n_near"), F.min("by").alias("by"))
    by = words.select(F.col("id").alias("by"), F.col("word").alias("best"), F.col("n").alias("best_n"))
    told = words.join(best, "id", "left").join(by, "by", "left").withColumn("has", F.coalesce(F.col("best_n") >= times * F.col("n"), F.lit(False)))
    told = materialize(told, "near-words")
    end = roots(told.where("has").select("id", F.col("by").alias("form"))).join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root")
    out = told.join(end.select("id", "root_word"), "id", "left")
    form = lambda c: F.when(F.col("has"), F.col(c))
    return out.select("word", form("best").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form("best_n").alias("form_n"))
