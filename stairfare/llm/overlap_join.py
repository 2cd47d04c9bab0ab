"""Near-copies of package texts by exact overlap of word shingles: a T-occurrence search.

Two texts link when their shingle sets' Jaccard similarity reaches ``LIMIT``.  The search is exact and
never lists the pairs of a group:

1. **Filter.**  Two linked texts share a known number of their smallest hashes.  Each text sends its
   smallest ``3/10`` of hashes, packed by hash range; a task per range says which of them any other
   text sent too.  Texts with too few shared ones link with nothing and are done.
2. **Classes.**  Equal sets are one class with one representative.
3. **Order.**  Over the representatives, shingles are ordered rarest first.  Linked texts share one of
   their first ``n/5 + 1``; those that occur once fill the front, so few are left to look up.
4. **Candidates.**  Each short inverted list is joined into a spanning forest of those of its texts
   that could link by size, place in the order, and a bit map of their sets.  Lists beyond
   ``LIST_AT_ONCE`` are dealt in blocks.
5. **Search.**  Texts joined by candidates meet in blocks of ``BLOCK``.  There an inverted index is built
   and every text is a query: its short lists are merged by a heap, its long ones probed by binary
   search (DivideSkip), and texts reaching the required overlap are linked, unless linked already.
"""

import heapq
from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..sources.tables import scratch
from .components import components
from .hashing import mixed, ranks, shingle_sets
from .records import KEY, TEXT, keyed, without

SHINGLE, LIMIT = 5, 80
BLOCK, LIST_AT_ONCE = 256, 2_048
#: Words of 64 bits in a set's bit map.
MAP_WORDS = 16
#: Bytes of text that one numpy pass takes.
PASS_BYTES = 4_000_000
#: Bytes of text for one range of hashes, which one task answers.
BUCKET_BYTES = 16_000_000
_NO_DOC = 65_535


def required(n, m):
    """Least overlap of linked sets of sizes n and m: 100 * o >= 80 * (n + m - o)."""
    return -(-LIMIT * (n + m) // (100 + LIMIT))


def _spare(n):
    """Shingles a set of size n may have that a linked one has not."""
    return n - -(-LIMIT * n // 100)


def _sent(n):
    return np.minimum(n, _spare(n) + -(-n // 10))


def _least_shared(n):
    """Of the hashes sent, so many at least a linked text has sent too (its own size is 4/5 of n at least)."""
    return -(-(-(-LIMIT * n // 100)) // 10)


def _passes(pdf: pd.DataFrame):
    """Slices of at most ``PASS_BYTES`` of text (one text at least) and fewer texts than ``_NO_DOC``."""
    size = pdf["__text"].str.len().to_numpy()
    first, total = 0, 0
    for i, s in enumerate(size):
        if i > first and (total + s > PASS_BYTES or i - first >= 8_000):
            yield pdf.iloc[first:i]
            first, total = i, 0
        total += s
    if first < len(pdf):
        yield pdf.iloc[first:]


def _pack(owner, h, buckets):
    """A pass's hashes by bucket, each once: ``(bucket, hashes, owners)``; of one that several of its
    texts have, the owner is ``_NO_DOC``, and those texts' own counts come beside."""
    order = np.argsort(h, kind="stable")
    h, owner = h[order], owner[order]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    group = np.cumsum(new) - 1
    count = np.bincount(group)
    several = count[group] > 1
    first = np.flatnonzero(new)
    who = np.where(count > 1, _NO_DOC, owner[first]).astype(np.uint16)
    unique = h[first]
    cut = np.searchsorted(unique, (np.arange(1, buckets, dtype=object) * ((1 << 64) // buckets)).astype(np.uint64))
    bounds = np.concatenate([[0], cut, [len(unique)]])
    return unique, who, count, bounds, owner[several]


def _send(buckets):
    def run(batches):
        for pdf in batches:
            for part in _passes(pdf):
                owner, h = shingle_sets(part["__text"].tolist(), SHINGLE)
                n = np.bincount(owner, minlength=len(part))
                keep = ranks(owner) < _sent(n)[owner]
                uid = part["__uid"].to_numpy()
                rows = []
                if keep.any():
                    unique, who, _, bounds, local = _pack(owner[keep], h[keep], buckets)
                    local = np.bincount(local, minlength=len(part))
                    for b in range(buckets):
                        x, w = unique[bounds[b]:bounds[b + 1]], who[bounds[b]:bounds[b + 1]]
                        if len(x):
                            own, at = np.unique(w, return_inverse=True)
                            ids = np.where(own == _NO_DOC, 0, uid[np.minimum(own, len(part) - 1)])
                            sizes = np.where(own == _NO_DOC, 0, n[np.minimum(own, len(part) - 1)])
                            rows.append((b, x.tobytes(), at.astype("<u2").tobytes(), ids.astype("<i8").tobytes(), sizes.astype("<i8").tobytes(), b""))
                else:
                    local = np.zeros(len(part), np.int64)
                rows.append((int(uid[0] % buckets), b"", b"", uid.astype("<i8").tobytes(), n.astype("<i8").tobytes(), local.astype("<i8").tobytes()))
                yield pd.DataFrame(rows, columns=["bucket", "hashes", "at", "uids", "sizes", "known"])
    return run


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """``uid, n, shared`` of one hash range: how many of a text's hashes some other pass sent as well."""
    arrays = [np.frombuffer(x, "<u8") for x in pdf["hashes"]]
    every = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    every.sort()
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    out = []
    for h, at, uids, sizes, known in zip(arrays, pdf["at"], pdf["uids"], pdf["sizes"], pdf["known"]):
        uid, n = np.frombuffer(uids, "<i8"), np.frombuffer(sizes, "<i8")
        if known:
            out.append((uid, n, np.frombuffer(known, "<i8")))
            continue
        place = np.searchsorted(twice, h)
        hit = (place < len(twice)) & (twice[np.minimum(place, len(twice) - 1)] == h) if len(twice) else np.zeros(len(h), bool)
        c = np.bincount(np.frombuffer(at, "<u2")[hit], minlength=len(uid))
        some = (c > 0) & (n > 0)
        out.append((uid[some], n[some], c[some]))
    uid, n, c = (np.concatenate(x) for x in zip(*out))
    return pd.DataFrame({"uid": uid, "n": n, "shared": c})


SETS = "uid long, n long, f1 long, f2 long, hashes binary"


def _sets(batches):
    for pdf in batches:
        for part in _passes(pdf):
            owner, h = shingle_sets(part["__text"].tolist(), SHINGLE)
            n = np.bincount(owner, minlength=len(part))
            f1, f2 = np.zeros(len(part), np.uint64), np.zeros(len(part), np.uint64)
            np.add.at(f1, owner, mixed(h ^ np.uint64(0x1234567)))
            np.add.at(f2, owner, mixed(h + np.uint64(0x89ABCDEF)))
            ends = np.cumsum(n)
            yield pd.DataFrame({"uid": part["__uid"].to_numpy(), "n": n, "f1": f1.view(np.int64), "f2": f2.view(np.int64),
                                "hashes": [h[e - k:e].tobytes() for e, k in zip(ends, n)]})


PACKED = "hashes binary, at binary, uids binary, sizes binary"


def _send_sets(buckets):
    """Whole sets, packed by hash range, to learn how many sets have each hash."""
    def run(batches):
        for pdf in batches:
            size = pdf["n"].to_numpy()
            for first in range(0, len(pdf), 500):
                part = pdf.iloc[first:first + 500]
                n = size[first:first + 500]
                h = np.frombuffer(b"".join(part["hashes"]), "<u8")
                owner = np.repeat(np.arange(len(part)), n)
                order = np.argsort(h, kind="stable")
                h, owner = h[order], owner[order].astype("<u2")
                cut = np.searchsorted(h, (np.arange(1, buckets, dtype=object) * ((1 << 64) // buckets)).astype(np.uint64))
                bounds = np.concatenate([[0], cut, [len(h)]])
                uid = part["uid"].to_numpy()
                rows = []
                for b in range(buckets):
                    x, w = h[bounds[b]:bounds[b + 1]], owner[bounds[b]:bounds[b + 1]]
                    if len(x):
                        own, at = np.unique(w, return_inverse=True)
                        rows.append((b, x.tobytes(), at.astype("<u2").tobytes(), uid[own].astype("<i8").tobytes(), n[own].astype("<i8").tobytes()))
                yield pd.DataFrame(rows, columns=["bucket", "hashes", "at", "uids", "sizes"])
    return run


def _count(groups):
    """One hash range: each set's hashes that other sets have as well, with the number of sets, packed by set."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        h = np.concatenate([np.frombuffer(x, "<u8") for x in pdf["hashes"]])
        at = [np.frombuffer(x, "<u2") for x in pdf["at"]]
        uid = np.concatenate([np.frombuffer(u, "<i8")[a] for u, a in zip(pdf["uids"], at)])
        n = np.concatenate([np.frombuffer(s, "<i8")[a] for s, a in zip(pdf["sizes"], at)])
        _, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
        df = count[inverse]
        some = df > 1
        h, uid, n, df = h[some], uid[some], n[some], df[some]
        group = uid % groups
        order = np.lexsort((uid, group))
        h, uid, n, df, group = h[order], uid[order], n[order], df[order], group[order]
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(h)] if len(h) else [0]
        return pd.DataFrame([(int(group[lo]), h[lo:hi].tobytes(), np.minimum(df[lo:hi], (1 << 32) - 1).astype("<u4").tobytes(),
                              uid[lo:hi].tobytes(), n[lo:hi].tobytes()) for lo, hi in zip(cuts[:-1], cuts[1:])],
                            columns=["bucket", "hashes", "counts", "uids", "sizes"])
    return run


POSTINGS = "h long, uid long, n long, place long, map binary"


def _first_places(pdf: pd.DataFrame) -> pd.DataFrame:
    """Postings of each set's rarest shared hashes, as many as a linked set must meet; none if too few are shared."""
    h, df, uid, n = (np.concatenate([np.frombuffer(x, t) for x in pdf[c]])
                     for c, t in (("hashes", "<u8"), ("counts", "<u4"), ("uids", "<i8"), ("sizes", "<i8")))
    order = np.lexsort((h, df, uid))
    h, uid, n = h[order], uid[order], n[order]
    rows = []
    cuts = [0, *(np.flatnonzero(np.diff(uid)) + 1).tolist(), len(uid)]
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        alone = int(n[lo]) - (hi - lo)
        look = int(_spare(int(n[lo]))) + 1 - alone
        if look > 0:
            bits = parity_map(h[lo:hi])
            rows += [(x, int(uid[lo]), int(n[lo]), alone + i, bits) for i, x in enumerate(h[lo:min(hi, lo + look)].view(np.int64).tolist())]
    return pd.DataFrame(rows, columns=["h", "uid", "n", "place", "map"])


def parity_map(shared: np.ndarray) -> bytes:
    """Parity bit map of a set's shared hashes.

    Hashes that no other set has are left out: they can only add to the difference.
    """
    bit = shared % np.uint64(64 * MAP_WORDS)
    odd = np.flatnonzero(np.bincount(bit.astype(np.int64), minlength=64 * MAP_WORDS) & 1)
    words = np.zeros(MAP_WORDS, np.uint64)
    np.bitwise_or.at(words, odd // 64, np.uint64(1) << (odd % 64).astype(np.uint64))
    return words.astype("<u8").tobytes()


def forest(uid: np.ndarray, n: np.ndarray, place: np.ndarray, maps: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join those texts of one list that could link over this list or through each other."""
    left = np.arange(len(uid))
    edges = []
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            x = frontier.pop()
            need = required(n[x], n[left])
            fits = (need <= np.minimum(n[x], n[left])) & (place[x] <= n[x] - need) & (place[left] <= n[left] - need)
            fits &= np.bitwise_count(maps[left] ^ maps[x]).sum(axis=1) <= n[x] + n[left] - 2 * need
            for y in left[fits]:
                edges.append((int(uid[x]), int(uid[y])))
                frontier.append(y)
            left = left[~fits]
    return edges


def _forests(batches):
    """Spanning forests of lists; rows come sorted by list, and a list may go on in the next batch."""
    held = None

    def joined(pdf):
        edges = []
        keys = pdf[["h", "i", "j"]].to_numpy()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        uid, n, place = (pdf[c].to_numpy() for c in ("uid", "n", "place"))
        for lo, hi in zip([0, *cuts], [*cuts, len(pdf)]):
            if hi - lo > 1:
                maps = np.frombuffer(b"".join(pdf["map"].iloc[lo:hi]), "<u8").reshape(-1, MAP_WORDS)
                edges += forest(uid[lo:hi], n[lo:hi], place[lo:hi], maps)
        return pd.DataFrame(edges, columns=["a", "b"], dtype=np.int64)

    for pdf in batches:
        pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        last = pdf.iloc[-1] if len(pdf) else None
        if last is None:
            continue
        open_ = (pdf["h"] == last["h"]) & (pdf["i"] == last["i"]) & (pdf["j"] == last["j"])
        held, done = pdf[open_], pdf[~open_]
        if len(done):
            yield joined(done)
    if held is not None and len(held):
        yield joined(held)


def search(uids: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Linking edges among the sets of a block: a spanning forest of all its links.

    DivideSkip: of a query of n shingles, linked sets have at least ``t`` (4/5 of n); all but the
    ``n - t + 1`` shortest lists may then be left out of the merge, since a linked set is in one of
    those.  What the merge finds is looked up in the long lists by binary search, shortest first, until
    the overlap is reached or out of reach.
    """
    index: dict[int, list[int]] = {}
    lists = []
    for i, s in enumerate(sets):
        own = []
        for x in s.tolist():
            got = index.get(x)
            if got is None:
                got = index[x] = []
            got.append(i)
            own.append(got)
        lists.append(own)
    root = list(range(len(sets)))

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    apart, edges = len(sets), []
    for i, own in enumerate(lists):
        if apart == 1:
            break
        n = len(own)
        own = sorted(own, key=len)
        short = n - -(-LIMIT * n // 100) + 1
        merged = heapq.merge(*[x for x in own[:short] if len(x) > 1])
        seen: dict[int, int] = {}
        for j in merged:
            seen[j] = seen.get(j, 0) + 1
        long = own[short:]
        for j, have in seen.items():
            if j == i or top(j) == top(i):
                continue
            m = len(sets[j])
            need = int(required(n, m))
            if need > min(n, m):
                continue
            rest = len(long)
            for x in long:
                if have >= need or have + rest < need:
                    break
                rest -= 1
                at = bisect_left(x, j)
                have += at < len(x) and x[at] == j
            if have >= need:
                root[top(j)] = top(i)
                edges.append((uids[i], uids[j]))
                apart -= 1
    return edges


def _search(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("uid")
    return pd.DataFrame(search(pdf["uid"].tolist(), [np.frombuffer(x, "<u8") for x in pdf["hashes"]]), columns=["a", "b"], dtype=np.int64)


def _grid(parts, block, i: str, j: str):
    """Pairs of blocks that a row of block ``block`` out of ``parts`` belongs to."""
    return F.transform(F.sequence(F.lit(0), parts - 1), lambda o: F.struct(F.least(block, o).alias(i), F.greatest(block, o).alias(j)))


def link(packages: DataFrame, key: str = KEY, text: str = TEXT) -> DataFrame:
    """One row per package: ``package_key, n_shingles, component_key`` and ``__mark``.

    ``n_shingles`` is the size of its set of ``SHINGLE``-word shingles (A-Z lower-cased; a shorter text is
    one shingle); ``component_key`` is the smallest key reachable over links, its own included.

    Null, empty or blank text: empty set, linked with nothing.  Null keys are linked like others but
    never name a component that has another key.  Repeated rows each keep their row and link.  An empty table
    gives an empty one; other columns are not read.  Sets are compared by 64-bit hashes of their shingles.
    """
    spark = packages.sparkSession

    def written(df, label):
        folder = scratch(spark, label)
        df.write.option("compression", "zstd").parquet(folder)
        return spark.read.schema(df.schema).parquet(folder)

    base = keyed(packages, key, text).withColumn("__mark", F.xxhash64("__text")) \
        .withColumn("__uid", F.xxhash64(F.col("__key").cast("string"), "__text"))
    texts = base.select("__uid", "__text")
    size = texts.agg(F.sum(F.octet_length("__text").cast("long")).alias("n")).first()["n"] or 0
    # a group is a hash range of some megabytes, however the session is set
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    sent = texts.mapInPandas(_send(buckets), "bucket int, hashes binary, at binary, uids binary, sizes binary, known binary")
    sizes = written(sent.groupBy("bucket").applyInPandas(_answer, "uid long, n long, shared long")
                    .groupBy("uid").agg(F.max("n").alias("n"), F.sum("shared").alias("shared")), "sizes")
    least = F.ceil(F.ceil(F.col("n") * LIMIT / 100) / 10)
    some = sizes.where((F.col("n") > 0) & (F.col("shared") >= least)).select(F.col("uid").alias("__uid"))
    sets = written(texts.join(some, "__uid", "left_semi").mapInPandas(_sets, SETS), "sets")

    # groups are aggregated and written before rows look them up: that join has a plain shuffle on either side, so a hot group is split
    own = sets.select("uid", "n", "f1", "f2").distinct()
    classes = written(own.groupBy("n", "f1", "f2").agg(F.min("uid").alias("rep"), F.count("*").alias("copies")).where("copies > 1").drop("copies"), "copies")
    member = written(own.join(classes, ["n", "f1", "f2"], "left").select("uid", F.coalesce("rep", "uid").alias("rep")), "classes")
    firsts = member.where("uid = rep").select("uid")
    reps = sets.join(firsts, "uid", "left_semi").dropDuplicates(["uid"]).select("uid", "n", "hashes")
    reps = written(reps, "representatives")

    counted = reps.mapInPandas(_send_sets(buckets), f"bucket int, {PACKED}").groupBy("bucket") \
        .applyInPandas(_count(buckets), "bucket int, hashes binary, counts binary, uids binary, sizes binary")
    postings = written(counted.groupBy("bucket").applyInPandas(_first_places, POSTINGS), "postings")
    long_lists = written(postings.groupBy("h").agg(F.ceil(F.count("*") / LIST_AT_ONCE).cast("int").alias("parts")).where("parts > 1"), "long-lists")
    dealt = postings.join(long_lists, "h", "left").withColumn("parts", F.coalesce("parts", F.lit(1))) \
        .withColumn("block", F.pmod(F.xxhash64("uid", F.lit(7)), F.col("parts")).cast("int")) \
        .withColumn("ij", F.explode(_grid(F.col("parts"), F.col("block"), "i", "j"))) \
        .select("h", "ij.i", "ij.j", "uid", "n", "place", "map")
    candidates = dealt.repartition(buckets, "h", "i", "j").sortWithinPartitions("h", "i", "j", "uid").mapInPandas(_forests, "a long, b long").distinct()
    near = written(components(candidates), "near")

    size = written(near.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")).where("parts > 1"), "large-groups")
    blocks = near.join(size, "root", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("node", F.lit(11)), F.col("parts")).cast("int")) \
        .withColumn("ij", F.explode(_grid(F.col("parts"), F.col("block"), "i", "j"))) \
        .select(F.col("node").alias("uid"), "root", "ij.i", "ij.j")
    links = blocks.join(reps.select("uid", "hashes"), "uid").groupBy("root", "i", "j").applyInPandas(_search, "a long, b long")
    found = components(links)

    group = member.join(found, member["rep"] == found["node"], "left").select("uid", F.coalesce("root", "rep").alias("root"))
    named = written(base.select("__key", "__mark", "__uid").join(group, F.col("__uid") == F.col("uid"), "left").drop("uid") \
        .join(sizes.select("uid", "n"), F.col("__uid") == F.col("uid"), "left").drop("uid") \
        .withColumn("root", F.coalesce("root", "__uid")), "named")  # else all unlinked rows would meet in one task
    lowest = written(named.groupBy("root").agg(F.min("__key").alias("lowest"), F.count("*").alias("members")).where("members > 1").drop("members"), "lowest")
    return named.join(lowest, "root", "left").select(
        F.col("__key").alias(key), F.coalesce("n", F.lit(0)).alias("n_shingles"),
        F.coalesce("lowest", "__key").alias("component_key"), "__mark")


def keep_one(packages: DataFrame, key: str = KEY, text: str = TEXT) -> DataFrame:
    """``packages`` with the one of each group whose key names it; columns unchanged, repeated rows of it stay."""
    rest = link(packages, key, text).where(F.col(f"`{key}`") != F.col("component_key")) \
        .select(F.col(f"`{key}`").alias("__key"), "__mark").distinct()
    return without(packages, rest, key, text)
