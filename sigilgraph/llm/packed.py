"""Byte tables of fixed size that the driver broadcasts without unpacking them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame


def pack(values: np.ndarray) -> bytes:
    """A part of a table as tasks hand it to ``collect``."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


class Packed:
    """A uint8 table in parts of equal size. It is pickled in its compressed form; the first ``array`` in a process unpacks it. Absent
    parts are zeros."""

    def __init__(self, size: int, step: int, parts: dict[int, bytes]):
        self.size, self.step, self.parts = size, step, parts
        self._array: np.ndarray | None = None

    @classmethod
    def collect(cls, rows: DataFrame, size: int, step: int) -> Packed:
        """From rows (number of the part, part), a row for each part."""
        return cls(size, step, {number: bytes(part) for number, part in rows.collect()})

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_array": None}

    def array(self) -> np.ndarray:
        if self._array is None:
            import zstandard

            out, unzip = np.zeros(self.size, np.uint8), zstandard.ZstdDecompressor()
            for number, part in self.parts.items():
                out[number * self.step : (number + 1) * self.step] = np.frombuffer(unzip.decompress(part), np.uint8)
            self._array = out
        return self._array
