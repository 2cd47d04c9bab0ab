"""Removal of long byte strings that occur twice anywhere, by sorted suffixes that are merged, not compared anew.

Sorting every suffix of every text is not needed to find repeats of ``LENGTH`` bytes.  Of each such string
the positions of its smallest ``SEED``-byte hash depend on its bytes alone, so equal strings have the same
*anchors*, about one in fifty bytes:

1. Anchors whose seed occurs once are dropped (a task per hash range sees them all).
2. Each task sorts the suffixes at its remaining anchors into a run and front-codes it: of each suffix
   only what differs from the one before is sent, with the length they share.  Equal suffixes are sent once.
3. Runs meet by seed range and are merged by a loser tree that knows how far each waiting suffix agrees with
   the last one out, and compares bytes beyond that only.  Suffixes that agree on the seed are a group.
4. Within a group, the strings of ``LENGTH`` bytes around the anchor are compared at each offset.

A seed that occurs more than ``LARGE`` times is no group of one task.  The strings around its anchors are hashed
where their texts are, counted there, and meet by hash range: one that occurs twice in a task is settled there
and sent once without its places, so that none is sent oftener than there are passes.
"""

import hashlib

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

from ..sources.tables import scratch
from .hashing import laid_out, mixed, running, stretches
from .portions import sliced
from .records import KEY, TEXT, keyed, restored

LENGTH, SEED = 200, 100
#: Offsets an anchor can have in a string.
OFFSETS = LENGTH - SEED + 1
#: Bytes whose hashes are in memory at once; longer texts are cut in stretches that overlap by ``LENGTH`` - 1.
PASS_BYTES = 512_000
#: Anchors that a task gathers before it sends them, and bytes of text for one range of hashes.
SENT_AT_ONCE, BUCKET_BYTES = 400_000, 8_000_000
#: Bytes of text whose places are put together by one task.
GROUP_BYTES = 32_000_000
#: Suffixes whose strings are compared in one numpy pass.
COMPARED_AT_ONCE = 3_000
#: Suffixes that a task sorts into one run.
RUN_SUFFIXES = 25_000
#: Places of a seed beyond which its strings meet by their own hashes.
LARGE = 4_000


def _slid(x: np.ndarray, n: int, better) -> np.ndarray:
    """``better`` over each n neighbours ``x[i:i + n]``, by doubling; as many as fit."""
    done = 1
    while done < n:
        step = min(done, n - done)
        x = better(x[:len(x) - step], x[step:])
        done += step
    return x


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text number, place, seed hash)`` of each text's anchors."""
    data, starts = laid_out(texts)
    none = np.empty(0, np.int64)
    if len(data) < LENGTH:
        return none, none, np.empty(0, np.uint64)
    at = np.arange(len(data) - SEED + 1)
    h = stretches(running(data), at, at + SEED)
    least = _slid(h, OFFSETS, np.minimum)
    owner = np.searchsorted(starts, np.arange(len(least)), side="right") - 1
    least = np.where(np.arange(len(least)) + LENGTH < starts[owner + 1], least, np.uint64(0))  # strings end before the blank behind a text
    best = _slid(np.concatenate([np.zeros(OFFSETS - 1, np.uint64), least, np.zeros(OFFSETS - 1, np.uint64)]), OFFSETS, np.maximum)
    place = np.flatnonzero((best[:len(h)] == h) & (h != 0))
    doc = np.searchsorted(starts, place, side="right") - 1
    return doc, place - starts[doc], h[place]


def _passes(texts: list[bytes]):
    """``(stretches, their text numbers, their places)`` of about ``PASS_BYTES`` together.

    Every string of ``LENGTH`` bytes lies in one stretch whole, so the anchors of a text are those of its stretches.
    """
    held, owners, places, total = [], [], [], 0
    for i, t in enumerate(texts):
        for lo in range(0, max(len(t) - LENGTH + 1, 1), PASS_BYTES):
            part = t[lo:lo + PASS_BYTES + LENGTH - 1]
            if held and (total + len(part) > PASS_BYTES or len(held) >= 8_000):
                yield held, np.array(owners), np.array(places)
                held, owners, places, total = [], [], [], 0
            held.append(part)
            owners.append(i)
            places.append(lo)
            total += len(part)
    if held:
        yield held, np.array(owners), np.array(places)


def _ranges(h: np.ndarray, buckets: int) -> np.ndarray:
    return np.minimum(h // np.uint64((1 << 64) // buckets), np.uint64(buckets - 1)).astype(np.int64)


def _send_seeds(buckets):
    """Rows of anchors by hash range; a task gathers many passes for one row a range."""
    def packed(held):
        h, uid, place = (np.concatenate(x) for x in zip(*held))
        b = _ranges(h, buckets)
        order = np.argsort(b, kind="stable")
        h, uid, place, b = h[order], uid[order], place[order], b[order]
        cuts = [0, *(np.flatnonzero(np.diff(b)) + 1).tolist(), len(b)]
        return pd.DataFrame([(int(b[x]), h[x:y].tobytes(), uid[x:y].tobytes(), place[x:y].tobytes()) for x, y in zip(cuts[:-1], cuts[1:]) if y > x],
                            columns=["bucket", "a", "uids", "places"])

    def run(batches):
        held, size = [], 0
        for pdf in batches:
            uid = pdf["__uid"].to_numpy()
            for parts, owner, offset in _passes([t.encode("utf-8", "surrogatepass") for t in pdf["__text"]]):
                doc, place, h = anchors(parts)
                held.append((h, uid[owner[doc]].astype("<i8"), (place + offset[doc]).astype("<i4")))
                size += len(h)
                if size > SENT_AT_ONCE:
                    yield packed(held)
                    held, size = [], 0
        if size:
            yield packed(held)
    return run


def _joined(pdf, column, kind):
    return np.concatenate([np.frombuffer(x, kind) for x in pdf[column]])


def _by_text(uid, groups, *arrays):
    """Rows of arrays packed by text group, so that their number does not follow the number of texts."""
    g = uid % groups
    order = np.lexsort((uid, g))
    g = g[order]
    cuts = [0, *(np.flatnonzero(np.diff(g)) + 1).tolist(), len(g)] if len(g) else [0]
    packed = [x[order] for x in (uid, *arrays)]
    return [(int(g[lo]), *(x[lo:hi].tobytes() for x in packed)) for lo, hi in zip(cuts[:-1], cuts[1:])]


def _seen_twice(groups, large=LARGE):
    """Places of seeds that occur twice; those of large seeds as ``-1 - place``."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        h, uid, place = _joined(pdf, "a", "<u8"), _joined(pdf, "uids", "<i8"), _joined(pdf, "places", "<i4")
        _, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
        some = count[inverse] > 1
        place = np.where(count[inverse] > large, -1 - place, place).astype("<i4")
        return pd.DataFrame(_by_text(uid[some], groups, place[some]), columns=["bucket", "uids", "places"])
    return run


def _places(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row per text: its anchors whose seeds occur elsewhere."""
    uid, place = _joined(pdf, "uids", "<i8"), _joined(pdf, "places", "<i4")
    order = np.lexsort((place, uid))
    uid, place = uid[order], place[order]
    cuts = [0, *(np.flatnonzero(np.diff(uid)) + 1).tolist(), len(uid)] if len(uid) else [0]
    return pd.DataFrame([(int(uid[lo]), np.unique(place[lo:hi]).astype("<i4").tobytes()) for lo, hi in zip(cuts[:-1], cuts[1:])], columns=["uid", "places"])


def shared(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known to agree."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    lo, hi = known, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def front_coded(suffixes: list[bytes]) -> tuple[np.ndarray, bytes, np.ndarray]:
    """``(shared lengths, tails, tail lengths)`` of a sorted run."""
    lcp = [0, *(shared(a, b) for a, b in zip(suffixes, suffixes[1:]))] if suffixes else []
    tails = [s[k:] for s, k in zip(suffixes, lcp)]
    return np.array(lcp, "<u2"), b"".join(tails), np.array([len(t) for t in tails], "<u2")


class LoserTree:
    """Merges front-coded sorted runs.  Each waiting suffix keeps how much it shares with the last one out.

    Of two waiting suffixes the one that shares more is the smaller; only if both share as much are
    bytes compared, from there on.
    """

    def __init__(self, runs: list[tuple[np.ndarray, bytes, np.ndarray]]):
        self.runs = [(lcp.tolist(), tails, np.concatenate([[0], np.cumsum(n.astype(np.int64))]).tolist()) for lcp, tails, n in runs]
        self.width = 1 << max(len(runs) - 1, 0).bit_length()
        self.at = [0] * len(runs)
        self.head: list[bytes | None] = [None] * self.width
        self.known = [0] * self.width
        for r in range(len(runs)):
            self._next(r, 0)
        self.losers = [-1] * self.width
        self.winner = self._play(1)

    def _next(self, r: int, known: int):
        lcp, tails, ends = self.runs[r]
        i = self.at[r]
        if i == len(lcp):
            self.head[r] = None
            return
        before = self.head[r] or b""
        self.head[r] = before[:lcp[i]] + tails[ends[i]:ends[i + 1]]
        self.known[r] = lcp[i] if i else known
        self.at[r] = i + 1

    def _less(self, x: int, y: int) -> bool:
        a, b = self.head[x], self.head[y]
        if a is None or b is None:
            return b is None and a is not None
        kx, ky = self.known[x], self.known[y]
        if kx != ky:
            return kx > ky  # the loser keeps what it shares: with the winner no more than with the last one out
        k = shared(a, b, kx)
        smaller = k == len(a) and (k < len(b) or x < y) or k < len(a) and k < len(b) and a[k] < b[k]
        self.known[y if smaller else x] = k
        return smaller

    def _play(self, node: int) -> int:
        if node >= self.width:
            return node - self.width
        x, y = self._play(2 * node), self._play(2 * node + 1)
        if self._less(x, y):
            self.losers[node] = y
            return x
        self.losers[node] = x
        return y

    def __iter__(self):
        """``(run, suffix, bytes shared with the suffix before)`` in order."""
        while self.head[self.winner] is not None:
            r = self.winner
            yield r, self.head[r], self.known[r]
            self._next(r, 0)
            node = (r + self.width) // 2
            while node:
                if self._less(self.losers[node], r):
                    self.losers[node], r = r, self.losers[node]
                node //= 2
            self.winner = r


#: What a row holds: a run of suffixes, hashes of strings around large seeds, or stretches already settled.
SUFFIXES, HASHES, SETTLED = range(3)
RUN = ("kind int, bucket int, lcp binary, tails binary, lengths binary, left_lengths binary, lefts binary, many binary, uids binary, places binary, "
       "hashes binary, starts binary, ends binary")
RUN_COLUMNS = [c.split()[0] for c in RUN.split(", ")]


def _send_runs(buckets, groups=None):
    """Front-coded runs of suffixes (to ``LENGTH`` bytes), each with what stands before it, by seed range; their texts compressed."""
    groups = groups or buckets

    def pack(data):
        return zstandard.compress(data, 6)

    def packed(bucket, entries):
        entries.sort(key=lambda e: e[0])
        lcp, tails, lengths = front_coded([s for s, _, _ in entries])
        lefts = [x for _, x, _ in entries]
        where = [w for _, _, ws in entries for w in ws]
        return (SUFFIXES, bucket, lcp.tobytes(), pack(tails), lengths.tobytes(), np.array([len(x) for x in lefts], "<u2").tobytes(), pack(b"".join(lefts)),
                np.array([len(ws) for _, _, ws in entries], "<u4").tobytes(),
                np.array([u for u, _ in where], "<i8").tobytes(), np.array([p for _, p in where], "<i4").tobytes(), None, None, None)

    def frame(held, large):
        rows = [packed(b, [(s, x, w) for (s, x), w in e.items()]) for b, e in held.items()]
        return pd.DataFrame(rows + _by_string(buckets, large, groups), columns=RUN_COLUMNS)

    def run(batches):
        held: dict[int, dict[tuple[bytes, bytes], list]] = {}
        large: dict[tuple[bytes, bytes], list] = {}
        size = 0
        for pdf in batches:
            for uid, text, places in zip(pdf["__uid"].tolist(), pdf["__text"], pdf["places"]):
                data = text.encode("utf-8", "surrogatepass")
                for q in np.frombuffer(places, "<i4").tolist():
                    p = q if q >= 0 else -1 - q
                    around = data[p:p + LENGTH], data[max(p - OFFSETS + 1, 0):p]
                    if q < 0:
                        large.setdefault(around, []).append((uid, p))
                    else:
                        b = int.from_bytes(hashlib.blake2b(around[0][:SEED], digest_size=8).digest(), "little") % buckets
                        held.setdefault(b, {}).setdefault(around, []).append((uid, p))
                    size += 1
                    if size > RUN_SUFFIXES or len(large) >= COMPARED_AT_ONCE:
                        yield frame(held, large)
                        held, large, size = {}, {}, 0
        yield frame(held, large)
    return run


def _strings(suffixes: list[bytes], lefts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix and offset, the hash of the string that starts so many bytes before it, and whether there is one."""
    n, reach = len(suffixes), OFFSETS - 1
    data = np.frombuffer(b"".join(x.rjust(reach, b"\0") + s.ljust(LENGTH, b"\0") for x, s in zip(lefts, suffixes)), np.uint8).reshape(n, reach + LENGTH)
    sums = running(data.reshape(-1))
    base = (np.arange(n) * (reach + LENGTH))[:, None]
    offset = np.arange(OFFSETS)[None, :]
    start = base + reach - offset
    fits = (np.array([len(x) for x in lefts])[:, None] >= offset) & (np.array([len(s) for s in suffixes])[:, None] >= LENGTH - offset)
    return stretches(sums, start.reshape(-1), start.reshape(-1) + LENGTH).reshape(n, OFFSETS), fits


def _stretches_hit(hit: np.ndarray):
    """``(row, first offset, offset behind the last)`` of each run of hits."""
    edge = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    _, last = np.nonzero(edge == -1)
    return zip(row.tolist(), first.tolist(), last.tolist())


def _by_string(buckets: int, large: dict[tuple[bytes, bytes], list], groups: int) -> list[tuple]:
    """Rows for the strings around anchors of large seeds: those met twice here settled, each hash once by its range.

    A hash met twice here has no place, for it needs no answer.  The offset is part of the hash, since
    two anchors of one text can lie in the same string.
    """
    if not large:
        return []
    where = list(large.values())
    h, fits = _strings([s for s, _ in large], [x for _, x in large])
    row, offset = np.nonzero(fits)
    value = mixed(h[fits] + offset.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    many = np.array([len(w) for w in where])
    value, one, inverse = np.unique(value, return_index=True, return_inverse=True)
    twice = np.bincount(inverse, weights=many[row]) > 1
    hit = np.zeros(fits.shape, bool)
    hit[fits] = twice[inverse]
    spans = [(u, p - (b - 1), p - a + LENGTH) for k, a, b in _stretches_hit(hit) for u, p in where[k]]
    uid, start, end = np.array(spans, np.int64).reshape(-1, 3).T
    none = (None,) * 6
    out = [(SETTLED, b, *none, u, None, None, s, e) for b, u, s, e in _by_text(uid, groups, start, end)]
    first = np.array([w[0] for w in where], np.int64)
    owner = np.where(twice, 0, first[row[one], 0]).astype("<i8")
    place = np.where(twice, -1, first[row[one], 1] - offset[one]).astype("<i4")
    cuts = np.searchsorted(_ranges(value, buckets), np.arange(buckets + 1))
    return out + [(HASHES, b, *none, owner[x:y].tobytes(), place[x:y].tobytes(), value[x:y].tobytes(), None, None)
                  for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])) if y > x]


def _met_twice(pdf: pd.DataFrame, groups: int) -> list[tuple]:
    """Strings around large seeds that were met in two passes, or twice in one, by text."""
    h, uid, place = _joined(pdf, "hashes", "<u8"), _joined(pdf, "uids", "<i8"), _joined(pdf, "places", "<i4").astype("<i8")
    _, inverse = np.unique(h, return_inverse=True)
    some = (np.bincount(inverse, weights=np.where(place < 0, 2, 1))[inverse] > 1) & (place >= 0)
    return _by_text(uid[some], groups, place[some], place[some] + LENGTH)


def _repeated_offsets(suffixes: list[bytes], lefts: list[bytes], group: np.ndarray, many: np.ndarray) -> np.ndarray:
    """For each suffix and offset, whether the string that starts so many bytes before it occurs twice."""
    h, fits = _strings(suffixes, lefts)
    n, offset = len(suffixes), np.arange(OFFSETS)[None, :]
    slot = (group[:, None] * OFFSETS + offset)[fits]
    value = h[fits]
    order = np.lexsort((value, slot))
    s, v = slot[order], value[order]
    new = np.concatenate([[True], (s[1:] != s[:-1]) | (v[1:] != v[:-1])]) if len(s) else np.empty(0, bool)
    run = np.cumsum(new) - 1
    total = np.bincount(run, weights=np.broadcast_to(many[:, None], (n, OFFSETS))[fits][order]) if len(s) else np.empty(0)
    twice = np.zeros(len(s), bool)
    twice[order] = total[run] > 1 if len(s) else twice
    out = np.zeros((n, OFFSETS), bool)
    out[fits] = twice
    return out


def _covered(groups):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        kind = pdf["kind"].iloc[0]
        if kind != SUFFIXES:
            rows = _met_twice(pdf, groups) if kind == HASHES else list(zip(*[pdf[c] for c in ("bucket", "uids", "starts", "ends")]))
            return pd.DataFrame(rows, columns=["bucket", "uids", "starts", "ends"])
        plain = zstandard.ZstdDecompressor().decompress
        runs = [tuple(np.frombuffer(x, "<u2") if k != 1 else plain(x) for k, x in enumerate(r)) for r in zip(pdf["lcp"], pdf["tails"], pdf["lengths"])]
        side = []
        for lengths, lefts, many, uids, places in zip(pdf["left_lengths"], pdf["lefts"], pdf["many"], pdf["uids"], pdf["places"]):
            ends = np.concatenate([[0], np.cumsum(np.frombuffer(lengths, "<u2").astype(np.int64))]).tolist()
            count = np.frombuffer(many, "<u4").astype(np.int64)
            side.append((plain(lefts), ends, count, np.concatenate([[0], np.cumsum(count)]), np.frombuffer(uids, "<i8"), np.frombuffer(places, "<i4")))
        seen = [0] * len(runs)
        out_uid, out_start, out_end = [], [], []
        held: list = []

        def settle():
            if not held:
                return
            group = np.array([g for _, _, g, _, _ in held])
            many = np.array([side[r][2][i] for _, _, _, r, i in held])
            hit = _repeated_offsets([s for s, _, _, _, _ in held], [x for _, x, _, _, _ in held], group, many)
            for k, a, b in _stretches_hit(hit):
                _, _, _, r, i = held[k]
                _, _, _, bounds, uids, places = side[r]
                u, p = uids[bounds[i]:bounds[i + 1]], places[bounds[i]:bounds[i + 1]].astype(np.int64)
                out_uid.append(u)
                out_start.append(p - (b - 1))
                out_end.append(p - a + LENGTH)
            held.clear()

        number = 0
        for r, suffix, known in LoserTree(runs):
            i = seen[r]
            seen[r] += 1
            if known < SEED:
                number += 1
                if len(held) >= COMPARED_AT_ONCE:
                    settle()
            lefts, ends = side[r][0], side[r][1]
            held.append((suffix, lefts[ends[i]:ends[i + 1]], number, r, i))
        settle()
        if not out_uid:
            return pd.DataFrame([], columns=["bucket", "uids", "starts", "ends"])
        uid, start, end = np.concatenate(out_uid), np.concatenate(out_start), np.concatenate(out_end)
        return pd.DataFrame(_by_text(uid, groups, start, end), columns=["bucket", "uids", "starts", "ends"])
    return run


def _spans(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row per text: its covered stretches, merged."""
    uid, start, end = (_joined(pdf, c, "<i8") for c in ("uids", "starts", "ends"))
    order = np.lexsort((start, uid))
    uid, start, end = uid[order], start[order], end[order]
    rows = []
    cuts = [0, *(np.flatnonzero(np.diff(uid)) + 1).tolist(), len(uid)] if len(uid) else [0]
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        s, upto = start[lo:hi], np.maximum.accumulate(end[lo:hi])
        new = np.concatenate([[True], s[1:] > upto[:-1]])
        first = np.flatnonzero(new)
        rows.append((int(uid[lo]), s[first].astype("<i8").tobytes(), upto[np.concatenate([first[1:] - 1, [hi - lo - 1]])].astype("<i8").tobytes()))
    return pd.DataFrame(rows, columns=["uid", "starts", "ends"])


def _cut(batches):
    for pdf in batches:
        rows = []
        for key, text, starts, ends in zip(pdf["__key"], pdf["__text"], pdf["starts"], pdf["ends"]):
            data = text.encode("utf-8", "surrogatepass")
            s, e = (np.frombuffer(x or b"", "<i8").tolist() for x in (starts, ends))
            kept = b"".join(data[x:y] for x, y in zip([0, *e], [*s, len(data)]))
            rows.append((key, len(data), len(data) - len(kept), len(s), kept, [{"start": x, "end": y} for x, y in zip(s, e)]))
        yield pd.DataFrame(rows, columns=["__key", "n_bytes", "n_removed", "n_spans", "kept", "spans"])


def remove_repeats(packages: DataFrame, key: str = KEY, text: str = TEXT) -> DataFrame:
    """One row per package: ``package_key, n_bytes, n_removed, n_spans, kept, spans``.

    A byte is removed if a string of ``LENGTH`` bytes of its text covers it that starts anywhere else too, in
    the same text or another; overlapping ones count, and all are judged on the input.  ``kept`` are the
    other bytes, ``spans`` the maximal removed stretches in bytes, ends exclusive.

    Null, empty or short text: nothing removed.  Null keys stay; repeated rows are texts of their own, so
    they repeat each other, and each keeps its row.  An empty table gives an empty one; other columns are
    not read.  Strings are compared by 64-bit hashes among those that agree on ``SEED`` bytes.
    """
    spark = packages.sparkSession

    def written(df, label):
        folder = scratch(spark, label)
        df.write.option("compression", "zstd").parquet(folder)
        return spark.read.schema(df.schema).parquet(folder)

    base = keyed(packages, key, text, for_python=True).withColumn("__uid", F.xxhash64("__key", "__text"))
    texts = base.select("__uid", "__text").where(F.octet_length("__text") >= LENGTH)
    size = texts.agg(F.sum(F.octet_length("__text").cast("long")).alias("n")).first()["n"] or 0
    # a group is a hash range, or some texts, of some megabytes, however the session is set
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets, groups = max(least, -(-size // BUCKET_BYTES)), max(least, -(-size // GROUP_BYTES))
    def mapped(df, run, schema):
        return df.mapInArrow(sliced(run, "__text", 4 * PASS_BYTES, schema), schema)

    places = mapped(texts, _send_seeds(buckets), "bucket int, a binary, uids binary, places binary") \
        .groupBy("bucket").applyInPandas(_seen_twice(groups), "bucket int, uids binary, places binary") \
        .groupBy("bucket").applyInPandas(_places, "uid long, places binary")
    places = written(places, "anchors")
    runs = mapped(texts.join(places, F.col("__uid") == F.col("uid")).select("__uid", "__text", "places"), _send_runs(buckets, groups), RUN)
    spans = runs.groupBy("kind", "bucket").applyInPandas(_covered(groups), "bucket int, uids binary, starts binary, ends binary") \
        .groupBy("bucket").applyInPandas(_spans, "uid long, starts binary, ends binary")
    spans = written(spans, "repeats")
    out = mapped(base.join(spans, F.col("__uid") == F.col("uid"), "left").select("__key", "__text", "starts", "ends"), _cut,
                 "__key string, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<start:long,end:long>>")
    return restored(out.withColumnRenamed("__key", key), key, packages)
