"""Training windows of fixed length from whole texts, packed online in bounded space.

Each task keeps a fixed number of open windows.  A piece goes to the open window it fills best; when
it fits none and no more may be opened, the fullest window takes as much of it as it has room for and
is emitted.  Windows still open when the task ends are merged with those of other tasks by the same
rule, and what is left then is cut into windows whose length is a power of two, which need no padding.
"""

import bisect
import math

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..sources.tables import scratch
from . import tokens
from .records import KEY, TEXT, keyed, restored

WINDOW, OPEN_WINDOWS, END_ID = 2048, 16, 1
#: Pieces of unfinished windows that one task merges.
MERGED_AT_ONCE = 5_000

PIECE = "{key} string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, is_open boolean"
#: Ids of windows finished by merging lie above those of the first pass.
_MERGED = 1 << 61


class Packer:
    """Places pieces ``(key, start, ids, doc_tokens)`` and returns the rows of finished windows."""

    def __init__(self, first_id: int, window: int, open_windows: int):
        self.next_id, self.window, self.most = first_id, window, open_windows
        self.room: list[tuple[int, int]] = []  # (free, id), sorted
        self.held: dict[int, list] = {}

    def _rows(self, number: int, pieces: list, is_open: bool) -> list[tuple]:
        out, offset = [], 0
        for key, start, ids, total in pieces:
            out.append((key, start, len(ids), ids.tobytes(), total, number, offset, is_open))
            offset += len(ids)
        return out

    def _new(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def _put(self, at: int, piece) -> list[tuple]:
        """Into the window at ``at`` of ``room``, which has space; its rows if that finishes it."""
        free, number = self.room.pop(at)
        self.held[number].append(piece)
        free -= len(piece[2])
        if free:
            bisect.insort(self.room, (free, number))
            return []
        return self._rows(number, self.held.pop(number), False)

    def add(self, key, start: int, ids: np.ndarray, total: int) -> list[tuple]:
        out = []
        while len(ids) >= self.window:
            out += self._rows(self._new(), [(key, start, ids[:self.window], total)], False)
            start, ids = start + self.window, ids[self.window:]
        while len(ids):
            at = bisect.bisect_left(self.room, (len(ids), -1))
            if at < len(self.room):
                return out + self._put(at, (key, start, ids, total))
            if len(self.room) < self.most:
                number = self._new()
                self.held[number] = []
                bisect.insort(self.room, (self.window, number))
                continue
            free = self.room[0][0]
            out += self._put(0, (key, start, ids[:free], total))
            start, ids = start + free, ids[free:]
        return out

    def unfinished(self) -> list[tuple]:
        """Rows of the windows still open."""
        return [r for _, number in self.room for r in self._rows(number, self.held[number], True)]

    def drained(self) -> list[tuple]:
        """The open windows laid end to end and cut: whole windows, then falling powers of two."""
        pieces = [p for _, number in self.room for p in self.held[number]]
        left = sum(len(p[2]) for p in pieces)
        out = []
        while left:
            size = min(self.window, 1 << (left.bit_length() - 1))
            left -= size
            taken = []
            while size:
                key, start, ids, total = pieces.pop(0)
                taken.append((key, start, ids[:size], total))
                if len(ids) > size:
                    pieces.insert(0, (key, start + size, ids[size:], total))
                size -= min(size, len(ids))
            out += self._rows(self._new(), taken, False)
        return out


def _frame(rows: list[tuple], key: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "is_open"])


def _first_pass(path, end_id, window, open_windows, key):
    def run(batches):
        packer = Packer(TaskContext.get().partitionId() << 32, window, open_windows)
        for pdf in batches:
            for at in range(0, len(pdf), tokens.TEXTS_AT_ONCE):
                part = pdf.iloc[at:at + tokens.TEXTS_AT_ONCE]
                rows = []
                for k, ids in zip(part["__key"], tokens.encode_documents(path, part["__text"].tolist(), end_id)):
                    rows += packer.add(k, 0, ids, len(ids))
                yield _frame(rows, key)
        yield _frame(packer.unfinished(), key)
    return run


def _merge(window, open_windows, key):
    def run(batches):
        packer = Packer(_MERGED + (TaskContext.get().partitionId() << 32), window, open_windows)
        for pdf in batches:
            rows = []
            for k, start, ids, total in zip(pdf[key], pdf["start"], pdf["ids"], pdf["doc_tokens"]):
                rows += packer.add(k, start, np.frombuffer(ids, "<u4"), total)
            yield _frame(rows, key)
        yield _frame(packer.drained(), key)
    return run


def pack(packages: DataFrame, tokenizer: str, key: str = KEY, text: str = TEXT, window: int = WINDOW,
         open_windows: int = OPEN_WINDOWS, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``package_key, start, length, ids, doc_tokens, sequence_id, offset``.

    A text's ids are those of the tokenizer file, then ``end_id``.  ``start`` is the piece's place in
    its text's ids, ``offset`` its place in the window ``sequence_id``; ``ids`` are little-endian 32-bit
    integers.  Every id lies in exactly one piece and every window is full or, among the last of a
    merging task, a power of two long: nothing is padded.

    Null or empty text: the end id alone.  Null keys stay; repeated rows are packed each.  An empty
    table gives no window.  Other columns are not read.  A task holds ``open_windows`` windows,
    however long its texts.  The pieces are written once to the shared folder, so that a lost executor
    costs its tasks only.
    """
    spark = packages.sparkSession
    schema = PIECE.format(key=f"`{key}`")
    folder = scratch(spark, "windows")
    keyed(packages, key, text, for_python=True).mapInPandas(_first_pass(tokenizer, end_id, window, open_windows, key), schema) \
        .write.option("compression", "zstd").parquet(folder)
    rows = spark.read.schema(schema).parquet(folder)
    left = rows.where("is_open")
    tasks = max(1, math.ceil(left.count() / MERGED_AT_ONCE))
    merged = left.repartition(tasks, F.xxhash64("sequence_id", "offset")).mapInPandas(_merge(window, open_windows, key), schema)
    return restored(rows.where("not is_open").unionByName(merged).drop("is_open"), key, packages)
