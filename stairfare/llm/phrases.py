"""Phrases whose words stand together more often than their parts would by chance, per carrier or any other group.

Only the longest windows are counted: each word of a text with the words behind it, in lead columns ``w1`` to
``w5`` that are padded where the piece ends.  A phrase of k words occurs as often as it leads a window, so Spark's
ROLLUP over the columns sums the windows to all shorter phrases, and to the words of the group, in one pass.

A window need not be longer than its phrases can be frequent.  Before it is counted, words and pairs of neighbours are
counted by hash bucket, then triples whose pairs may be frequent; a bucket below the threshold holds no frequent
one, so windows are padded from there.  A bucket can only seem too frequent, never too rare: nothing is lost, and the
bit sets of buckets have a fixed bound.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..sources.tables import scratch
from .hashing import laid_out, mixed, running, stretches
from .portions import slices, tiles
from .records import TEXT

LONGEST, LEAST, TOP = 5, 100, 2_000
#: Name of the group of rows without one.
NO_GROUP = "und"
PASS_BYTES = 1_000_000
#: Bytes of text for one bucket, and bounds of their number (a power of two); a bit each goes to every task.
BYTES_A_BUCKET, FEWEST_BUCKETS, MOST_BUCKETS = 64, 1 << 16, 1 << 28
#: Bucket numbers that a task counts at once.
COUNTED_AT_ONCE = 1_000_000
#: Groups whose word totals are broadcast; beyond it they are joined by a shuffle.
BROADCAST_GROUPS = 10_000

_BREAK, _BLANK, _WORD = 1, 2, 0
_KIND = np.zeros(256, np.uint8)
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = _BREAK
_KIND[list(b" \t")] = _BLANK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BORDER = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")


def _ahead(words: int) -> re.Pattern:
    return re.compile(rb"(?:[ \t]+[^ \t.,;:!?\n\x0b\x0c\r]+){0,%d}" % words)


class Words:
    """The words of some texts: ``code`` into ``names``, whether a window starts there, whether the next word is in its piece."""

    def __init__(self, texts: list[bytes], groups: np.ndarray, longest: int):
        parts = [(own, more, g) for t, g in zip(texts, groups.tolist()) for own, more in tiles(t, PASS_BYTES, _BORDER, _ahead(longest - 1))]
        data = np.frombuffer(b"\n".join([own + more for own, more, _ in parts]) + b"\n", np.uint8)
        data = _LOWER[data]
        size = np.array([len(own) + len(more) + 1 for own, more, _ in parts], np.int64)
        first = np.cumsum(size) - size
        own_end = first + np.array([len(own) for own, _, _ in parts], np.int64)
        kind = _KIND[data]
        in_word = kind == _WORD
        edge = np.flatnonzero(np.diff(in_word, prepend=False, append=False))
        start, end = edge[::2], edge[1::2]
        letters = data[in_word]
        ends = np.cumsum(end - start).astype(np.int32)
        offsets = np.concatenate([np.zeros(1, np.int32), ends])
        encoded = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        self.code = encoded.indices.to_numpy()
        self.names = encoded.dictionary
        piece = np.cumsum(kind == _BREAK)[start] if len(start) else np.empty(0, np.int64)
        owner = np.searchsorted(first, start, side="right") - 1
        self.starts = start < own_end[owner]
        self.group = np.array([g for _, _, g in parts], np.int64)[owner]
        self.follows = np.zeros(len(start), bool)
        self.follows[:-1] = piece[1:] == piece[:-1]
        self._hash()

    def _hash(self):
        data, starts = laid_out(self.names.to_pylist())
        self.hash = stretches(running(data), starts[:-1], starts[1:] - 1)

    def buckets(self, group_hash: np.ndarray, count: int, most: int) -> list[np.ndarray]:
        """For 1 to ``most`` words the bucket of the run that starts at each word, right where it stays in its piece."""
        shift = np.uint64(64 - (count.bit_length() - 1))
        h = self.hash[self.code]
        value = mixed(h ^ group_hash[self.group])
        out = [(value >> shift).astype(np.int32)]
        for n in range(1, most):
            value = value.copy()
            value[:-n] = mixed(value[:-n] * np.uint64(0x9E3779B97F4A7C15) + h[n:])
            out.append((value >> shift).astype(np.int32))
        return out


def _known(bits, bucket: np.ndarray) -> np.ndarray:
    known = np.frombuffer(bits.value, np.uint8)
    return (known[bucket >> 3] >> (bucket & 7).astype(np.uint8)) & 1 == 1


def _then(runs: np.ndarray, n: int) -> np.ndarray:
    """``runs`` moved ``n`` words back: whether the word behind by ``n`` has the property."""
    return np.concatenate([runs[n:], np.zeros(min(n, len(runs)), bool)])


def _read(batches, longest: int):
    """``(words, names of groups, hashes of groups)`` of one portion after the other."""
    for batch in batches:
        for lo, hi in slices(batch, "__text", PASS_BYTES):
            part = batch.slice(lo, hi - lo)
            groups = part.column("__group").dictionary_encode()
            names = groups.dictionary.to_pylist()
            data, starts = laid_out([n.encode() for n in names])
            hashes = stretches(running(data), starts[:-1], starts[1:] - 1) * np.uint64(0xD6E8FEB86659FD93)
            yield Words(part.column("__text").cast(pa.binary()).to_pylist(), groups.indices.to_numpy(), longest), names, hashes


def _count_buckets(count: int, longest: int, pairs=None):
    """Buckets of words and pairs; with the bits of frequent ones, those of triples of frequent pairs."""
    def merged(held):
        bucket, inverse = np.unique(np.concatenate([b for b, _ in held]), return_inverse=True)
        return bucket, np.bincount(inverse, weights=np.concatenate([c for _, c in held])).astype(np.int32)

    def met(words, hashes):
        if pairs is None:
            one, two = words.buckets(hashes, count, 2)
            return np.concatenate([one[words.starts], two[words.starts & words.follows]])
        _, two, three = words.buckets(hashes, count, 3)
        on = words.follows & _known(pairs, two)
        return three[words.starts & on & _then(on, 1)]

    def run(batches):
        held, size = [], 0
        for words, _, hashes in _read(batches, longest):
            held.append(np.unique(met(words, hashes), return_counts=True))
            size += len(held[-1][0])
            if size > COUNTED_AT_ONCE:
                held = [merged(held)]
                if len(held[0][0]) > COUNTED_AT_ONCE // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(held[0][0]), pa.array(held[0][1])], names=["bucket", "n"])
                    held = []
                size = sum(len(b) for b, _ in held)
        if held:
            bucket, n = merged(held)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(n)], names=["bucket", "n"])
    return run


def _frequent_buckets(texts: DataFrame, count: int, longest: int, least: int, pairs=None):
    """A bit for each bucket, set where it is met ``least`` times, broadcast: ``count / 8`` bytes, 32 MB at most."""
    met = texts.mapInArrow(_count_buckets(count, longest, pairs), "bucket int, n int") \
        .groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    # the functions count from 1 on: number b + 1 lies in map 1 + b // 32768 at b % 32768
    maps = met.groupBy(F.expr("bitmap_bucket_number(bucket + 1L)").alias("at")) \
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bucket + 1L))").alias("bits")).collect()
    out = bytearray(count // 8)
    for r in maps:
        lo = (r["at"] - 1) * 4_096
        out[lo:lo + 4_096] = r["bits"][:len(out) - lo]
    return texts.sparkSession.sparkContext.broadcast(bytes(out))


def _windows(pairs, triples, count: int, longest: int):
    columns = [f"w{j + 1}" for j in range(longest)]

    def run(batches):
        for words, groups, hashes in _read(batches, longest):
            one, two, three = words.buckets(hashes, count, 3)
            here = _known(pairs, one)
            on = words.follows & _known(pairs, two) & _then(here, 1)
            third = _known(triples, three) if longest > 2 else on
            code = np.where(here, words.code + 1, 0).astype(np.int32)
            lead = {"g": words.group.astype(np.int32)[words.starts]}
            alive = here
            for j, name in enumerate(columns):
                if j:
                    alive = alive & _then(on, j - 1)
                if j > 1:
                    alive = alive & _then(third, j - 2)
                column = np.zeros(len(code), np.int32)
                column[:len(code) - j] = np.where(alive[:len(code) - j], code[j:], 0)
                lead[name] = column[words.starts]
            counted = pa.table(lead).group_by(["g", *columns]).aggregate([([], "count_all")])
            names = pa.concat_arrays([pa.array([""], pa.string()), words.names.cast(pa.string())])
            yield pa.RecordBatch.from_arrays(
                [pa.array(groups, pa.string()).take(counted["g"].combine_chunks()), *[names.take(counted[c].combine_chunks()) for c in columns],
                 counted["count_all"].combine_chunks()], names=["__group", *columns, "n"])
    return run


def counts(packages: DataFrame, group: str = "carrier", text: str = TEXT, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """``__group, k, phrase, f``: every phrase of 1 to ``longest`` words met ``least`` times, and as ``k = 0`` all words of the group."""
    spark = packages.sparkSession
    texts = packages.select(F.coalesce(F.col(f"`{group}`").cast("string"), F.lit(NO_GROUP)).alias("__group"), F.col(f"`{text}`").alias("__text")) \
        .where(F.octet_length("__text") > 0)
    size = texts.agg(F.sum(F.octet_length("__text").cast("long")).alias("n")).first()["n"] or 0
    buckets = min(max(1 << max(size // BYTES_A_BUCKET, 1).bit_length(), FEWEST_BUCKETS), MOST_BUCKETS)
    pairs = _frequent_buckets(texts, buckets, longest, least)
    triples = _frequent_buckets(texts, buckets, longest, least, pairs) if longest > 2 else None
    w = [f"w{j + 1}" for j in range(longest)]
    windows = texts.mapInArrow(_windows(pairs, triples, buckets, longest), f"__group string, {', '.join(f'{c} string' for c in w)}, n long")
    rolled = windows.rollup("__group", *w).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    # the level has a bit for each column summed away: 2**longest - 1 leaves the group alone
    k = sum((F.when(F.col("level") < (1 << (longest - j)), 1).otherwise(0) for j in range(1, longest + 1)), F.lit(0))
    found = rolled.withColumn("k", k.cast("int"))
    last = F.get(F.array(F.lit("x"), *w), F.col("k"))
    # padded prefixes say nothing new; the condition names keys only, so the optimiser drops them before they are summed
    found = found.where((F.col("level") < (1 << longest)) & (last != ""))
    return found.where((F.col("k") == 0) | (F.col("f") >= least)) \
        .select("__group", "k", F.when(F.col("k") == 0, "").otherwise(F.array_join(F.slice(F.array(*w), F.lit(1), F.greatest("k", F.lit(1))), " ")).alias("phrase"), "f")


def _kept(spark: SparkSession, df: DataFrame) -> DataFrame:
    folder = scratch(spark, "phrases")
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def collocations(packages: DataFrame, group: str = "carrier", text: str = TEXT, longest: int = LONGEST, least: int = LEAST, top: int = TOP) -> DataFrame:
    """``carrier, rank, phrase, a, l, r, n, score``: the phrases of each carrier's descriptions that belong together most.

    Letters A-Z are lower-cased; ``. , ; : ! ?`` and line breaks end a piece, blanks and tabs a word.  ``a`` counts the phrase
    within pieces, overlaps included, ``n`` all words of the carrier.  Of a phrase of 2 to ``longest`` words with ``a >= least``,
    cut in two, ``l`` and ``r`` count its parts and the score is ``floor(1000 * a * n / (l * r))``; the cut with the least
    score counts, of equal ones that after the fewest words.  A phrase that lies in a longer one as frequent is left
    out.  The first ``top`` by score, then ``a`` (both falling), then phrase (by bytes) of each carrier have ``rank`` 1, 2, ...

    Null carrier: the carrier ``und``.  Null or empty text: no words.  Repeated rows count each.  An empty table, or one without
    frequent phrases, gives an empty one; other columns are not read.  Of one very long text a task holds ``PASS_BYTES`` bytes
    at once.  Counts are exact to 15 digits, products are decimals.
    """
    spark = packages.sparkSession
    found = _kept(spark, counts(packages, group, text, longest, least))
    totals = found.where("k = 0").select(F.col("__group").alias("__ngroup"), F.col("f").alias("n"))
    totals = F.broadcast(totals) if totals.count() <= BROADCAST_GROUPS else totals
    part = found.where("k > 0").select("__group", "phrase", "f")
    candidates = found.where("k > 1")
    words = F.split("phrase", " ", -1)
    cuts = candidates.withColumn("w", words).withColumn("at", F.explode(F.sequence(F.lit(1), F.col("k") - 1))) \
        .select("__group", "phrase", F.col("f").alias("a"), "at", F.array_join(F.slice("w", F.lit(1), F.col("at")), " ").alias("left"),
                F.array_join(F.slice("w", F.col("at") + 1, F.col("k") - F.col("at")), " ").alias("right"))
    cuts = cuts.join(part.select("__group", F.col("phrase").alias("left"), F.col("f").alias("l")), ["__group", "left"]) \
        .join(part.select("__group", F.col("phrase").alias("right"), F.col("f").alias("r")), ["__group", "right"]) \
        .join(totals, F.col("__group") == F.col("__ngroup"))
    exact = {c: F.col(c).cast("decimal(15,0)") for c in "anlr"}
    scored = cuts.withColumn("over", F.lit(1000).cast("decimal(4,0)") * exact["a"] * exact["n"]).withColumn("under", exact["l"] * exact["r"]) \
        .withColumn("score", F.expr("over div under")) \
        .groupBy("__group", "phrase").agg(F.min(F.struct("score", "at", "a", "l", "r", "n")).alias("cut"))
    # a phrase within a longer one as frequent is also within one longer by a word, which is as frequent
    longer = candidates.where("k > 2").withColumn("w", words)
    inner = longer.select("__group", F.col("f").alias("a"), F.explode(F.array(
        F.array_join(F.slice("w", F.lit(1), F.col("k") - 1), " "), F.array_join(F.slice("w", F.lit(2), F.col("k") - 1), " "))).alias("phrase"))
    whole = scored.select("__group", "phrase", "cut.*").join(inner, ["__group", "phrase", "a"], "left_anti")
    order = Window.partitionBy("__group").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return whole.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top) \
        .select(F.col("__group").alias(group), F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
