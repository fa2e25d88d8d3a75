"""Operator 1: token ids in a compressed binary store with access to single documents.

A store is a folder with three Parquet tables, so that Spark's committers write it and any Spark
reader opens it wherever it lies:

``dictionary``  (dict_hash, dictionary): one zstandard dictionary, trained on serialized id arrays.
``blocks``      (shard, block, dict_hash, first_doc, last_doc, doc_ids, lengths, starts, offsets, blob):
                ``blob`` joins the frames of consecutive documents. Frame *i*, blob[offsets[i]:offsets[i+1]],
                is the ids of document doc_ids[i] as little-endian unsigned integers of ``width`` bytes,
                compressed alone with the dictionary. ``starts`` counts ids in the shard before it.
``shards``      (shard, base): ids in all shards before this one.

Shards are ranges of doc_id in ascending order, as are documents in a shard. To read one document, the
filter first_doc <= id <= last_doc prunes blocks by Parquet statistics and one frame is decompressed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tokenize import encoded, encoder

END_ID = 2
#: A block is closed at so many documents or bytes of frames.
BLOCK_DOCS, BLOCK_BYTES = 1024, 1 << 20
_BLOCKS = "shard int, block int, dict_hash string, width int, first_doc long, last_doc long, doc_ids array<long>, lengths array<long>, starts array<long>, offsets array<long>, blob binary"


def serialize(ids: np.ndarray, width: int) -> bytes:
    return ids.astype("<u2" if width == 2 else "<u4").tobytes()


def train_dictionary(docs: DataFrame, tokenizer_path: str, width: int, sample_docs: int, dict_bytes: int) -> bytes:
    """The shared dictionary, from the whole ids of ``sample_docs`` documents of least hash (a bounded sample; nothing
    but compression depends on it). Empty if there is too little text to train on."""
    ids = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)  # ids alone are sorted
    picked = [r["doc_id"] for r in ids.collect() if r["doc_id"] is not None]
    if not picked:
        return b""
    sample = docs.where(F.col("doc_id").isin(picked)).dropDuplicates(["doc_id"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        rows = []
        for batch in batches:
            for _, ids, at in encoded(tokenizer_path, batch, END_ID):
                rows += [serialize(ids[i:j], width) for i, j in zip(at[:-1], at[1:])]
        rows = [r for r in rows if len(r) >= 8]
        out = b""
        if len(rows) >= 16 and sum(map(len, rows)) > 8 * dict_bytes:
            try:
                out = zstandard.train_dictionary(dict_bytes, rows, k=256, d=8).as_bytes()
            except zstandard.ZstdError:  # too uniform a sample
                out = b""
        yield pa.RecordBatch.from_pydict({"dictionary": pa.array([out], pa.binary())})

    return bytes(sample.coalesce(1).mapInArrow(train, "dictionary binary").first()["dictionary"])


def write_store(docs: DataFrame, path: str, tokenizer_path: str, *, end_id: int = END_ID, level: int = 3, dict_bytes: int = 32768, sample_docs: int = 400, shards: int | None = None) -> None:
    """Encode every whole text of ``docs`` (doc_id, text; others are ignored) and write a store.

    A null text is an empty one and has only ``end_id``. Rows are kept as they are: a repeated doc_id gives
    a document for each row, ordered by a hash of the text, and null ids come first. ``shards`` is the
    number of ranges (the session's shuffle partitions if None); a range is written in one task, as a stream.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    vocab = encoder(tokenizer_path).tokenizer.get_vocab_size(with_added_tokens=True)
    width = 2 if max(vocab, end_id + 1) <= 1 << 16 else 4
    dictionary = train_dictionary(rows, tokenizer_path, width, sample_docs, dict_bytes)
    dict_hash = f"{zlib.crc32(dictionary):08x}"
    spark.createDataFrame([(dict_hash, bytearray(dictionary))], "dict_hash string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        zd = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        zip_ = zstandard.ZstdCompressor(level=level, dict_data=zd)
        ids_, lengths, starts, frames, size, block, total = [], [], [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            off = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).tolist()
            known = [i for i in ids_ if i is not None]
            row = {"shard": shard, "block": block, "dict_hash": dict_hash, "width": width, "first_doc": min(known, default=None), "last_doc": max(known, default=None), "doc_ids": ids_, "lengths": lengths, "starts": starts, "offsets": off, "blob": b"".join(frames)}
            return pa.RecordBatch.from_pylist([row], schema=_arrow_schema())

        for batch in batches:
            for part, ids, at in encoded(tokenizer_path, batch, end_id):
                for i, a, z in zip(part.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    frame = zip_.compress(serialize(ids[a:z], width))
                    ids_.append(i), lengths.append(z - a), starts.append(total), frames.append(frame)
                    total, size = total + z - a, size + len(frame)
                    if len(frames) >= BLOCK_DOCS or size >= BLOCK_BYTES:
                        yield close()
                        ids_, lengths, starts, frames, size, block = [], [], [], [], 0, block + 1
        if frames:
            yield close()

    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("text")
    ranged = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
    ranged.mapInArrow(write, _BLOCKS).write.parquet(f"{path}/blocks")
    # One row for each shard; their number is a parameter.
    tokens = spark.read.parquet(f"{path}/blocks").select("shard", F.expr("aggregate(lengths, 0L, (a, x) -> a + x)").alias("n")).groupBy("shard").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    tokens.select("shard", F.coalesce(before, F.lit(0)).alias("base")).write.parquet(f"{path}/shards")


def _arrow_schema() -> pa.Schema:
    longs = pa.list_(pa.int64())
    return pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("dict_hash", pa.string()), ("width", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("doc_ids", longs), ("lengths", longs), ("starts", longs), ("offsets", longs), ("blob", pa.binary())])


def read_store(spark: SparkSession, path: str, doc_id: int | None = None, with_ids: bool = True) -> DataFrame:
    """Documents of a store: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, on
    request, ids as array<int>. With ``doc_id``, only blocks and frames that hold it are decoded.
    Raises ValueError if a block was written with another dictionary."""
    d = spark.read.parquet(f"{path}/dictionary").first()
    dictionary, dict_hash = bytes(d["dictionary"]), d["dict_hash"]
    blocks = spark.read.parquet(f"{path}/blocks")
    if doc_id is not None:
        blocks = blocks.where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unzip = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        for batch in batches:
            for r in range(batch.num_rows):
                b = {k: batch.column(k)[r].as_py() for k in ("shard", "dict_hash", "width", "doc_ids", "lengths", "starts", "offsets", "blob")}
                if b["dict_hash"] != dict_hash:
                    raise ValueError(f"block written with dictionary {b['dict_hash']}, the store has {dict_hash}")
                out: dict[str, list] = {"shard": [], "doc_id": [], "in_shard": [], "n_tokens": [], "ids_crc32": [], "ids": []}
                for k, i in enumerate(b["doc_ids"]):
                    if doc_id is not None and i != doc_id:
                        continue
                    raw = unzip.decompress(b["blob"][b["offsets"][k] : b["offsets"][k + 1]], max_output_size=b["width"] * b["lengths"][k])
                    ids = np.frombuffer(raw, "<u2" if b["width"] == 2 else "<u4").astype("<u4")
                    out["shard"].append(b["shard"]), out["doc_id"].append(i), out["in_shard"].append(b["starts"][k])
                    out["n_tokens"].append(len(ids)), out["ids_crc32"].append(zlib.crc32(ids.tobytes()))
                    if with_ids:
                        out["ids"].append(ids.astype(np.int32))
                cols = [pa.array(out["shard"], pa.int32()), *(pa.array(out[k], pa.int64()) for k in ("doc_id", "in_shard", "n_tokens", "ids_crc32"))]
                names = ["shard", "doc_id", "in_shard", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols, names = [*cols, pa.array(out["ids"], pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "shard int, doc_id long, in_shard long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    shards = F.broadcast(spark.read.parquet(f"{path}/shards"))  # a row for each shard
    out = blocks.mapInArrow(decode, schema).join(shards, "shard")
    return out.select("doc_id", (F.col("base") + F.col("in_shard")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
