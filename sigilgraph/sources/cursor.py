"""Cursors of feeds that are read again and again: where each source stands, what is read anew, and restarts.

A run reads the records that came since the source's cursor, less an overlap for late ones; it upserts them into a keyed table, and only
then moves the cursor. A run that dies in between is repeated by the next one, and what the overlap brings twice is one row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.store import KeyedTable, Rules, Written

# How far back a sync looks (its interval of 3 days and one more), and a pulse feed (seconds).
SYNC_OVERLAP, PULSE_OVERLAP = 4 * 86400, 300


@dataclass(frozen=True)
class Cursors:
    """A keyed table of (source, cursor timestamp, page, done): the latest cursor and the highest page win, so an old run cannot move them back."""

    spark: SparkSession
    path: str

    @property
    def table(self) -> KeyedTable:
        return KeyedTable(self.spark, self.path, Rules(["source"], latest=["cursor"], highest=["page", "done"]), buckets=1)

    def read(self, source: str) -> dict | None:
        """The state of a source; None if it has none yet."""
        if not self.table.manifest():
            return None
        r = self.table.read().where(F.col("source") == source).select("cursor", "page", "done").first()
        return r.asDict() if r else None

    def move(self, source: str, cursor=None, page: int | None = None, done: bool | None = None) -> None:
        row = [(source, cursor, page, None if done is None else int(done))]
        self.table.upsert(self.spark.createDataFrame(row, "source string, cursor timestamp, page int, done int"))


def fresh(records: DataFrame, at: str, cursor, overlap: int) -> DataFrame:
    """Records not older than the cursor less ``overlap`` seconds, all without a cursor. The bound is a literal, so it reaches the scan; a record
    without a time is always read."""
    if cursor is None:
        return records
    bound = F.lit(cursor).cast("timestamp") - F.make_dt_interval(secs=F.lit(float(overlap)))
    return records.where(F.col(at).isNull() | (F.col(at) >= bound))


def sync(records: DataFrame, source: str, at: str, table: KeyedTable, cursors: Cursors, overlap: int = SYNC_OVERLAP) -> Written:
    """One run: upserts the fresh ``records`` into ``table`` and moves the source's cursor to their latest time."""
    state = cursors.read(source)
    new = fresh(records, at, state and state["cursor"], overlap)
    last = new.agg(F.max(at).alias("last")).first()["last"]
    done = table.upsert(new)
    if last is not None:
        cursors.move(source, last)
    return done
