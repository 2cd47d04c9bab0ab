"""Batches and texts in portions of bounded size, so that a task's memory does not follow the length of a text."""

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def slices(batch: pa.RecordBatch, column: str, size: int):
    """``(first row, row behind the last)`` of portions of about ``size`` bytes of ``column``, a row at least."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(ends):
        hi = max(int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + size, side="right")), lo + 1)
        yield lo, hi
        lo = hi


def sliced(run, column: str, size: int, schema: str):
    """``run``, a function of pandas frames, for ``mapInArrow``: it gets a batch in portions of about ``size`` bytes of ``column``.

    Only one portion of a batch is Python strings at a time.  ``schema`` is that of what ``run`` yields.
    """
    out = to_arrow_schema(StructType.fromDDL(schema))

    def frames(batches):
        for batch in batches:
            for lo, hi in slices(batch, column, size):
                yield batch.slice(lo, hi - lo).to_pandas()

    def mapped(batches):
        for pdf in run(frames(batches)):
            yield pa.RecordBatch.from_pandas(pdf, schema=out, preserve_index=False)
    return mapped


def tiles(data: bytes, size: int, border: re.Pattern, ahead: re.Pattern):
    """``(own, ahead)``: stretches of ``data`` of about ``size`` bytes that end before a ``border``, which no word holds.

    ``ahead`` matches what a window that starts in a stretch can reach beyond it; nothing is counted from there.
    """
    lo = 0
    while len(data) - lo > size:
        end = border.search(data, lo + size)
        if end is None:
            break
        hi = end.start()
        yield data[lo:hi], ahead.match(data, hi).group()
        lo = hi
    yield data[lo:], b""


def filled(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of each stretch, one stretch behind the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def distinct(symbols: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(one stretch of each kind, kind of each stretch)``; stretches are compared symbol by symbol in the end."""
    factor = np.random.default_rng(7).integers(1, 1 << 62, int(size.max()), dtype=np.uint64) | np.uint64(1)
    start = np.cumsum(size) - size
    inside = np.arange(int(size.sum())) - np.repeat(start, size)
    own = symbols[inside + np.repeat(first, size)]
    value = (own.astype(np.uint64) + np.uint64(1)) * factor[inside]
    h = np.add.reduceat(value ^ (value >> np.uint64(29)), start)
    _, one, number = np.unique(h, return_index=True, return_inverse=True)
    same = size[one][number] == size
    if same.all():
        same = np.logical_and.reduceat(own == symbols[inside + np.repeat(first[one][number], size)], start)
    if not same.all():  # two kinds under one hash: every stretch is its own
        return np.arange(len(first)), np.arange(len(first))
    return one, number
