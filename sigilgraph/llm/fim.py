"""Operator 12: fill-in-middle transformation, by DuckDB inside mapInArrow.

Each batch is registered with the worker's DuckDB connection and transformed by one statement over Arrow data, so no row passes
through Python. A text is cut from left to right into blocks of 64 code points, and only the blocks that hold a cut into single
ones, both by regexp_extract_all; list_slice and array_to_string put prefix, middle and suffix together. So a text takes little more
memory than its bytes, however long it is. A document's cuts and form follow from a hash of its id alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T

#: Code points of a block, and bytes of text that a statement works on (one longer text may have more).
BLOCK, TEXT_BYTES = 64, 4 << 20
_connections: list = []

_CUT = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256(concat($seed, ':', doc_id)) AS h FROM batch),
b AS (
  SELECT doc_id, text, regexp_extract_all(text, '(?s).{{1,{BLOCK}}}') AS blocks,
    [('0x' || h[1:8])::UBIGINT, ('0x' || h[9:16])::UBIGINT, ('0x' || h[17:24])::UBIGINT, ('0x' || h[25:32])::UBIGINT] AS h FROM d),
n AS (
  SELECT *, CASE WHEN text = '' THEN 0 ELSE {BLOCK} * (len(blocks) - 1) + len(regexp_extract_all(blocks[-1], '(?s).')) END AS n FROM b),
f AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1))::BIGINT AS a, greatest(h[1] % (n + 1), h[2] % (n + 1))::BIGINT AS z,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= $rate THEN 'plain'
         WHEN h[4] % 100 < $spm THEN 'spm' ELSE 'psm' END AS form FROM n),
c AS (
  SELECT *, a // {BLOCK} AS ab, a % {BLOCK} AS ai, z // {BLOCK} AS zb, z % {BLOCK} AS zi,
    regexp_extract_all(coalesce(blocks[a // {BLOCK} + 1], ''), '(?s).') AS au, regexp_extract_all(coalesce(blocks[z // {BLOCK} + 1], ''), '(?s).') AS zu FROM f),
p AS (
  SELECT doc_id, n, form, a, z, text,
    list_slice(blocks, 1, ab) || list_slice(au, 1, ai) AS prefix,
    CASE WHEN ab = zb THEN list_slice(au, ai + 1, zi) ELSE list_slice(au, ai + 1, {BLOCK}) || list_slice(blocks, ab + 2, zb) || list_slice(zu, 1, zi) END AS middle,
    list_slice(zu, zi + 1, {BLOCK}) || list_slice(blocks, zb + 2, len(blocks)) AS suffix FROM c),
o AS (
  SELECT doc_id, n, form, a, z, CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN array_to_string(['<P>'] || prefix || ['<S>'] || suffix || ['<M>'] || middle, '')
    ELSE array_to_string(['<S>'] || suffix || ['<P>'] || prefix || ['<M>'] || middle, '') END AS output FROM p)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN z - a END AS middle_chars,
  sha256(output) AS output_sha256, output FROM o
"""

_RESTORE = """
WITH p AS (
  SELECT *, CASE form WHEN 'psm' THEN regexp_extract(output, '(?s)^<P>(.*?)<S>(.*?)<M>(.*)$', ['prefix', 'suffix', 'middle'])
    WHEN 'spm' THEN regexp_extract(output, '(?s)^<S>(.*?)<P>(.*?)<M>(.*)$', ['suffix', 'prefix', 'middle']) END AS parts FROM batch),
r AS (
  SELECT *, CASE WHEN form = 'plain' THEN output ELSE concat(parts.prefix, parts.middle, parts.suffix) END AS restored FROM p)
SELECT doc_id, n, form, prefix_chars, middle_chars, output_sha256, sha256(restored) AS restored_sha256, output, restored FROM r
"""

CUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, output string"
RESTORED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string, output string, restored string"


def connection():
    """The worker's DuckDB: one thread, in memory alone, as a task has one core and no disk of its own."""
    if not _connections:
        import duckdb

        _connections.append(duckdb.connect(":memory:", config={"threads": 1, "temp_directory": "", "preserve_insertion_order": True}))
    return _connections[0]


def _by_duckdb(rows: DataFrame, column: str, statement: str, schema: str, drop: tuple[str, ...] = (), **values) -> DataFrame:
    """``statement`` over table ``batch``, which holds a part of ``rows`` of some TEXT_BYTES of ``column``."""
    names = [f.split()[0] for f in schema.split(", ") if f.split()[0] not in drop]
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ") if f.split()[0] in names])
    query = f"SELECT {', '.join(names)} FROM ({statement})"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        db = connection()
        for batch in batches:
            for part in T.slices(batch, column, TEXT_BYTES):
                db.register("batch", pa.Table.from_batches([part]))
                out = db.sql(query, params=values).to_arrow_table()
                db.unregister("batch")
                yield from out.cast(fields).combine_chunks().to_batches()

    return rows.mapInArrow(run, ", ".join(f for f in schema.split(", ") if f.split()[0] in names))


def transform(docs: DataFrame, seed: str = "1", percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """CUT of every whole text of ``docs`` (doc_id, text; others are ignored): the text as prefix, suffix, middle (``psm``), suffix,
    prefix, middle (``spm``) or as it is (``plain``), the last for empty texts, texts with a marker in them, and all but ``percent``
    of a hundred documents. ``n`` and the parts' lengths count code points; a ``plain`` row has no parts.

    A null text is an empty one; a null doc_id hashes as no digits. Each row gives one, repeated rows equal ones. No shuffle."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _by_duckdb(rows, "text", _CUT, CUT, seed=seed, rate=percent, spm=spm_percent)


def restore(rows: DataFrame, with_text: bool = True) -> DataFrame:
    """RESTORED of rows of ``transform``: the text rebuilt from ``output`` and ``form`` alone (without both, if not ``with_text``)."""
    rows = rows.select(*[f.split()[0] for f in CUT.split(", ")])
    return _by_duckdb(rows, "output", _RESTORE, RESTORED, () if with_text else ("output", "restored"))
