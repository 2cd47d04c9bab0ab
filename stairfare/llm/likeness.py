"""Packages drawn so that their descriptions look like a wanted set, say the notes people wrote by hand.

Features are runs of words, hashed into buckets.  A bucket's gain is the logarithm of its share among the wanted
texts over its share among all, and a package's weight the mean gain of its features; the draw without
replacement keeps the highest weights after random noise (Gumbel) that depends on the key alone.

Inside tasks all is Arrow kernels and numpy on whole batches: lower-casing, splitting, flattening, dictionary encoding;
word numbers shifted against each other are the runs, each distinct run has its checksum taken once, and
gains are taken by bucket and summed by segment.
"""

import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import scratch
from .portions import slices, tiles
from .records import KEY, TEXT, keyed, restored

BUCKETS, LONGEST, LEAST_WORDS, SHARE, SEED = 10_000, 1, 20, 10, 2024
PASS_BYTES = 2_000_000
#: What stands between words: all ASCII but digits and letters (letters are lower-cased before).
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BORDER = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def _ahead(words: int) -> re.Pattern:
    return re.compile(rb"(?:[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+){0,%d}" % words)


def _tiled(texts: pa.Array, longest: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``(strings, row, own)``: long texts in tiles, each with what its last runs reach behind it as a string that is not its own."""
    if pc.max(pc.binary_length(texts)).as_py() <= PASS_BYTES:
        return texts, np.arange(len(texts)), np.ones(len(texts), bool)
    strings, row, own = [], [], []
    for i, text in enumerate(texts.cast(pa.binary()).to_pylist()):
        for part, more in tiles(text, PASS_BYTES, _BORDER, _ahead(longest - 1)):
            strings += [part, more]
            row += [i, i]
            own += [True, False]
    return pa.array(strings, pa.binary()).cast(pa.string()), np.array(row), np.array(own)


def features(texts: pa.Array, buckets: int = BUCKETS, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(words of each text, text number of each feature, bucket of each feature)``, features by length, then in order."""
    n_texts = len(texts)
    if not n_texts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    strings, row, own = _tiled(texts, longest)
    lists = pc.split_pattern_regex(pc.ascii_lower(strings), _BETWEEN)
    words, part = pc.list_flatten(lists), pc.list_parent_indices(lists)
    some = pc.greater(pc.binary_length(words), 0)
    encoded = words.filter(some).dictionary_encode()
    code = encoded.indices.to_numpy().astype(np.int64)
    part = part.filter(some).to_numpy()
    # a tile's own words and those behind it are one run of words, from which only own ones start a feature
    owner, starts = row[part], own[part]
    run = np.cumsum(own)[part]
    names = [w.encode() for w in encoded.dictionary.to_pylist()]
    sums = [zlib.crc32(w) for w in names]
    firsts, found = [], []
    number = code  # of the run of n words that starts at each word, among the distinct ones
    for n in range(1, longest + 1):
        if n > 1:
            fits = (run[n - 1:] == run[:len(run) - n + 1])
            pair = number[:len(code) - n + 1] * np.int64(len(names) + 1) + np.where(fits, code[n - 1:], len(names))
            distinct, number = np.unique(pair, return_inverse=True)
            before, last = np.divmod(distinct, len(names) + 1)
            sums = [zlib.crc32(b" " + names[w], sums[p]) if w < len(names) else 0 for p, w in zip(before.tolist(), last.tolist())]
        else:
            fits = np.ones(len(code), bool)
        bucket = (np.array(sums, np.int64) % buckets)[number] if len(sums) else np.empty(0, np.int64)
        use = fits & starts[:len(fits)]
        firsts.append(owner[:len(fits)][use])
        found.append(bucket[use])
        if len(number) == 0:
            break
    return np.bincount(owner[starts], minlength=n_texts), np.concatenate(firsts), np.concatenate(found)


def _portions(batches):
    for batch in batches:
        for lo, hi in slices(batch, "__text", PASS_BYTES):
            yield batch.slice(lo, hi - lo)


def bucket_counts(texts: DataFrame, text: str = TEXT, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How many features of all texts lie in each bucket; the driver gets a number a bucket, however many texts there are."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for part in _portions(batches):
            total += np.bincount(features(part.column("__text"), buckets, longest)[2], minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", "n"])

    rows = texts.select(F.col(f"`{text}`").alias("__text")).where(F.octet_length("__text") > 0) \
        .mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(have: np.ndarray, want: np.ndarray) -> np.ndarray:
    """A thousand times the logarithm of how much likelier each bucket is among the wanted features, floored."""
    buckets, all_have, all_want = len(have), int(have.sum()), int(want.sum())
    return np.array([math.floor(1000 * math.log(((t + 1) * (all_have + buckets)) / ((s + 1) * (all_want + buckets))))
                     for s, t in zip(have.tolist(), want.tolist())], np.int64)


def _weighed(gain: np.ndarray, longest: int):
    def run(batches):
        for part in _portions(batches):
            words, owner, bucket = features(part.column("__text"), len(gain), longest)
            order = np.argsort(owner, kind="stable")
            n = np.bincount(owner, minlength=len(part))
            total = np.zeros(len(part), np.int64)
            some = np.flatnonzero(n)
            if len(some):
                total[some] = np.add.reduceat(gain[bucket[order]], (np.cumsum(n) - n)[some])
            weight = total // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([part.column("__key"), pa.array(words.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(weight)],
                                             names=["__key", "n_words", "n_features", "weight"])
    return run


def _written(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    folder = scratch(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def draw_like(packages: DataFrame, notes: DataFrame, key: str = KEY, text: str = TEXT, note: str = TEXT, buckets: int = BUCKETS, longest: int = LONGEST,
              least_words: int = LEAST_WORDS, share: int = SHARE, seed: int = SEED) -> DataFrame:
    """One row per package: ``package_key, n_words, n_features, weight, score, rank``.

    Letters A-Z are lower-cased; words are runs of digits, letters and all beyond ASCII.  ``weight`` is the floored mean of the
    gains of the description's features (0 without any), ``score`` the weight with the key's noise, in thousandths.  Of the
    packages of ``least_words`` words or more, ``share`` per cent (floored) are drawn: the highest scores, ties to the smaller
    key; ``rank`` is their place from 1 on and null for the others.

    Null or empty text: no words, weight 0, never drawn (unless ``least_words`` is 0).  A null key has the noise of an empty one
    and comes before other keys of its score; repeated rows are packages each, with their own rank.  An empty table gives an
    empty one, without notes all gains follow from the packages alone.  Other columns of either table are not read.  No task
    sees more than its range of the scores; the driver gets a number a bucket and two a range.
    """
    spark = packages.sparkSession
    base = keyed(packages, key, text, for_python=True)
    gain = gains(bucket_counts(base, "__text", buckets, longest), bucket_counts(notes, note, buckets, longest))
    weighed = restored(base.mapInArrow(_weighed(gain, longest), "__key string, n_words long, n_features long, weight long")
                       .withColumnRenamed("__key", "__own"), "__own", packages.select(F.col(f"`{key}`").alias("__own")))
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("__own").cast("string"), F.lit(""))), 256), 1, 8)
    even = (F.conv(digits, 16, 10).cast("long") + 0.5) / 4294967296
    scored = weighed.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(even))).cast("long")) \
        .withColumn("__in", F.col("n_words") >= least_words)
    scored = _written(spark, scored, "scores")
    order = [F.col("__in").desc(), F.col("score").desc(), F.col("__own").asc_nulls_first()]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = _written(spark, scored.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
                      .withColumn("__place", F.monotonically_increasing_id()), "places")
    at = F.shiftright("__place", 33)
    sizes = placed.groupBy(at.alias("at")).agg(F.count("*").alias("n"), F.count(F.when(F.col("__in"), 1)).alias("fit")).orderBy("at").collect()
    before, rows = 0, []
    for r in sizes:
        rows.append((r["at"], before))
        before += r["n"]
    drawn = share * sum(r["fit"] for r in sizes) // 100
    first = spark.createDataFrame(rows, "at long, before long")
    rank = F.col("before") + F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.withColumn("at", at).join(F.broadcast(first), "at") \
        .select(F.col("__own").alias(key), "n_words", "n_features", "weight", "score", F.when(rank <= drawn, rank).alias("rank"))
