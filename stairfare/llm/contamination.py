"""Benchmark decontamination: packages whose text repeats windows of a question set.

The question set is cut into windows of consecutive words.  Every package text is scanned once:
from a text only seeds at fixed strides are looked up in a hash set of the questions' seeds (each
window of the text holds a whole seed, so none is missed), the windows around a hit are then
compared word by word.
"""

from pyspark.sql import Column, DataFrame, functions as F

from .records import KEY, TEXT, keyed, once, packed, row_mark, unpacked, without

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs of digits, letters and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Question windows that are sent to every executor at most; beyond it the joins shuffle.
BROADCAST_WINDOWS = 2_000_000


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _joined(words: Column, start: Column, n: int) -> Column:
    return F.array_join(F.slice(words, start + 1, F.lit(n)), " ")


def _plan(k: int) -> tuple[int, int]:
    """Seed length and stride: any k consecutive words hold a whole seed that starts at a multiple of the stride."""
    seed = (k + 1) // 2
    return seed, k - seed + 1


def _seed(words: Column, start: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), F.lower(_joined(words, start, _plan(k)[0])))


def question_windows(questions: DataFrame, item: str = "item_id", text: str = "text", window: int = 13) -> DataFrame:
    """``k, w, items``: each window's word count, its words joined by blanks, and the items holding it.

    A question of fewer words than ``window``, but not none, is one window; a null text has none.
    """
    q = questions.select(F.col(f"`{item}`").cast("string").alias("__item"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    q = once(q, __words=_words(F.translate("__text", UPPER, LOWER))).drop("__text").withColumn("__n", F.size("__words")).where("__n > 0") \
        .withColumn("__k", F.least("__n", F.lit(window)))
    starts = F.sequence(F.lit(0), F.col("__n") - F.col("__k"))
    w = F.transform(starts, lambda s: F.array_join(F.slice("__words", s + 1, F.col("__k")), " "))
    return q.select(F.col("__k").alias("k"), "__item", F.explode(F.array_distinct(w)).alias("w")) \
        .groupBy("k", "w").agg(F.collect_set("__item").alias("items"))


def _seeds_of_windows(windows: DataFrame, lengths: list[int]) -> DataFrame:
    """Every run of seed length inside a window, hashed without case; ``k, h`` once each."""
    windows = once(windows, __words=F.split("w", " "))
    words = F.col("__words")
    def seeds(k):
        run = _plan(k)[0]
        return F.when(F.col("k") == k, F.transform(F.sequence(F.lit(0), F.lit(k - run)), lambda s: _seed(words, s, k)))

    per_k = [seeds(k) for k in lengths]
    return windows.select(F.col("k").alias("sk"), F.explode(F.coalesce(*per_k)).alias("sh")).distinct()


def overlap(packages: DataFrame, questions: DataFrame, key: str = KEY, text: str = TEXT, item: str = "item_id",
            item_text: str = "text", window: int = 13, share: int = 20) -> DataFrame:
    """One row per package: ``package_key, n_words, n_hit, n_items, items, contaminated`` and ``__mark``.

    Letters A-Z are lower-cased.  A word is hit if any occurrence of a question window covers it;
    ``items`` are the question ids (as text, sorted) with an occurring window; a package is
    contaminated if ``n_hit > 0`` and ``share * n_hit >= n_words``.

    Null or empty text: no words, nothing hit, not contaminated.  No questions: nothing hit.  Null
    keys are kept as they are; repeated rows each keep their row.  Other columns of either table are
    not read.  Question windows go to all executors only up to ``BROADCAST_WINDOWS`` of them.
    """
    spark = packages.sparkSession
    windows = question_windows(questions, item, item_text, window)
    known = {r["k"]: r["n"] for r in windows.groupBy("k").agg(F.count("*").alias("n")).collect()}  # at most ``window`` rows
    lengths = sorted(known)
    few = sum(known.values()) <= BROADCAST_WINDOWS
    small = F.broadcast if few else (lambda df: df)

    p = once(keyed(packages, key, text), __mark=row_mark(), __words=_words(F.col("__text"))).drop("__text") \
        .withColumn("__n", F.size("__words"))
    none = F.array(F.struct(F.lit(0).alias("k"), F.lit(-1).alias("p"), F.lit(0).cast("long").alias("h")))

    def seeds_of_text(k):
        seed, stride = _plan(k)
        runs = F.transform(F.sequence(F.lit(0), F.col("__n") - seed, F.lit(stride)), lambda s: F.struct(
            F.lit(k).alias("k"), s.alias("p"), _seed(F.col("__words"), s, k).alias("h")))
        return F.when(F.col("__n") >= k, runs).otherwise(F.slice(none, 1, 0))

    # beside a broadcast the words may ride on their seeds; a shuffle carries keys, places and hashes only
    carried = ["__key", "__mark", "__n", *(["__words"] if few else [])]
    rows = p.withColumn("__seeds", F.concat(none, *[seeds_of_text(k) for k in lengths])) \
        .select(*carried, F.explode("__seeds").alias("e")).select(*carried, "e.k", "e.p", "e.h")
    if lengths:
        seeds = small(_seeds_of_windows(windows, lengths).withColumn("found", F.lit(True)))
    else:
        seeds = spark.createDataFrame([], "sk int, sh long, found boolean")
    hits = rows.join(seeds, (F.col("k") == F.col("sk")) & (F.col("h") == F.col("sh")), "left") \
        .where("p < 0 or found")
    if not few:
        words = p.select(F.col("__key").alias("__wkey"), F.col("__mark").alias("__wmark"), "__words").dropDuplicates(["__wkey", "__wmark"])
        own = F.col("__mark").eqNullSafe(F.col("__wmark")) & F.col("__key").eqNullSafe(F.col("__wkey"))
        hits = hits.where("p < 0").withColumn("__words", F.lit(None).cast("array<string>")).unionByName(
            hits.where("p >= 0").join(words, own).drop("__wkey", "__wmark"))
    # windows around a hit seed, in the words as the rule compares them
    def windows_around(k):
        starts = F.sequence(F.greatest(F.col("p") - _plan(k)[1] + 1, F.lit(0)), F.least(F.col("p"), F.col("__n") - k))
        return F.when((F.col("k") == k) & (F.col("p") >= 0), F.transform(starts, lambda s: F.struct(
            s.alias("s"), F.translate(_joined(F.col("__words"), s, k), UPPER, LOWER).alias("w"))))

    empty = F.lit(None).cast("array<struct<s:int,w:string>>")
    tried = hits.withColumn("__around", F.coalesce(*[windows_around(k) for k in lengths], empty)) \
        .select("__key", "__mark", "__n", "k", (F.col("p") < 0).alias("first"), F.explode_outer("__around").alias("e")) \
        .select("__key", "__mark", "__n", "first", F.col("k").alias("tk"), "e.s", F.col("e.w").alias("tw"))
    found = tried.join(small(windows), (F.col("tk") == F.col("k")) & (F.col("tw") == F.col("w")), "left") \
        .where("first or items is not null")
    per_row = found.groupBy("__key", "__mark").agg(
        F.max("__n").alias("n_words"), F.count(F.when(F.col("first"), 1)).alias("copies"),
        F.array_sort(F.collect_set(F.when(F.col("items").isNotNull(), F.struct("s", "tk")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    covered = F.aggregate(
        "hits", F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")),
        lambda a, h: F.struct(F.greatest(a["upto"], h["s"] + h["tk"]).alias("upto"),
                              (a["n"] + F.greatest(F.lit(0), h["s"] + h["tk"] - F.greatest(a["upto"], h["s"]))).alias("n")),
        lambda a: a["n"])
    out = per_row.withColumn("n_hit", covered.cast("long")).select(
        F.col("__key").alias(key), F.col("n_words").cast("long").alias("n_words"), "n_hit",
        F.size("items").cast("long").alias("n_items"), "items",
        ((F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "__mark", "copies", "hits")
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("__copy", "copies")


def drop_contaminated(packages: DataFrame, questions: DataFrame, key: str = KEY, text: str = TEXT, **rules) -> DataFrame:
    """``packages`` without the contaminated ones, columns unchanged."""
    bad = overlap(packages, questions, key, text, **rules).where("contaminated") \
        .select(F.col(f"`{key}`").alias("__key"), "__mark").distinct()
    return without(packages, bad, key, text)


def cut_spans(packages: DataFrame, questions: DataFrame, key: str = KEY, text: str = TEXT, **rules) -> DataFrame:
    """``packages`` with every hit word taken out of the text, separators kept; columns unchanged."""
    hits = overlap(packages, questions, key, text, **rules).where("n_hit > 0") \
        .select(F.col(f"`{key}`").alias("__hkey"), F.col("__mark").alias("__hmark"), F.col("hits").alias("__hits")).distinct()
    marked = packed(packages, __own=F.col(f"`{key}`"), __given=F.col(f"`{text}`"), __text_mark=F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    joined = marked.join(hits, F.col("__text_mark").eqNullSafe(F.col("__hmark")) & F.col("__own").eqNullSafe(F.col("__hkey")), "left")
    words, gaps = _words(F.col("__given")), F.split(F.col("__given"), WORD)
    kept = F.transform(words, lambda w, i: F.when(F.exists("__hits", lambda h: (h["s"] <= i) & (i < h["s"] + h["tk"])), "").otherwise(w))
    rebuilt = F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get(kept, i), F.lit("")))), "")
    return unpacked(joined, packages.columns, **{text: F.when(F.col("__hits").isNull(), F.col("__given")).otherwise(rebuilt)})
