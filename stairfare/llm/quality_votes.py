"""Text quality by weak supervision: rules vote or abstain, and what they agree on decides.

Each rule looks at one figure of a text and votes good, bad or not at all.  How far each rule can be
trusted is not set by hand: expectation-maximisation over the vote patterns of all texts estimates
every rule's accuracies and each pattern's probability of being good.  The patterns are at most
``3 ** len(RULES)``, however many texts there are, so they fit the driver.
"""

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..sources.tables import scratch
from .records import KEY, TEXT, keyed, restored, without

#: name -> (figure, good if at most, bad if at least); a figure in between is no vote.
RULES = {
    "symbols": ("symbol_share", 0.02, 0.10),
    "marked_words": ("marked_share", 0.05, 0.20),
    "capitals": ("capital_share", 0.15, 0.50),
    "repeats": ("repeat_share", 0.10, 0.45),
    "line_copies": ("dup_line_share", 0.10, 0.60),
    "shouting": ("shout_share", 0.02, 0.20),
    "loose_marks": ("loose_share", 0.05, 0.25),
    "rare_ends": ("open_line_share", 0.50, 0.90),
    "word_length": ("length_gap", 2.5, 6.0),
}
FIGURES = [v[0] for v in RULES.values()]
#: Share of good texts before any vote, bounds of a rule's accuracy on either class, and most rounds.
PRIOR, LEAST, MOST, ROUNDS = 0.8, 0.005, 0.999, 100
#: Texts of fewer words, or with a larger share of repeated words, fail whatever the rules say.
LEAST_WORDS, MOST_REPEATED = 50, 50

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_MARKED = re.compile(r"[#*$%&|<>]+")
_LOOSE = re.compile(r"(?:^|[\x20\x09-\x0D])[^\w\x20\x09-\x0D]+(?=[\x20\x09-\x0D]|$)")
SCHEMA = ("__key string, __mark long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          + ", ".join(f"v_{r} int" for r in RULES))


def _repeated(words: list[str]) -> int:
    """Words inside any three-word window that occurs twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[str, int] = {}
    at = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    windows = (at[:-2] * len(ids) + at[1:-1]) if len(ids) < 1 << 31 else None
    _, pair = np.unique(windows, return_inverse=True)
    _, inverse, counts = np.unique(pair * np.int64(len(ids)) + at[2:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[starts + k] = True
    return int(hit.sum())


def measure(text: str) -> tuple[int, int, int, int, int, dict[str, float]]:
    """Words, characters in words, symbols, repeated lines, repeated words, and the rules' figures of one text."""
    words = WORD.findall(text)
    n, chars = len(words), sum(map(len, words))
    symbols = sum(text.count(c) for c in SYMBOLS)
    seen, dup, lines, unended = set(), 0, 0, 0
    for line in text.split("\n"):
        bare = line.strip(SPACE)
        if bare:
            lines += 1
            unended += bare[-1] not in ".!?…:;\"'»)”"
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    repeated = _repeated(words)
    figures = {
        "symbol_share": symbols / max(chars, 1),
        "marked_share": len(_MARKED.findall(text)) / max(n, 1),
        "capital_share": len(_CAPITAL.findall(text)) / max(chars, 1),
        "repeat_share": repeated / max(n, 1),
        "dup_line_share": dup / max(lines, 1),
        "shout_share": text.count("!") / max(n, 1),
        "loose_share": len(_LOOSE.findall(text)) / max(n, 1),
        "open_line_share": unended / max(lines, 1),
        "length_gap": abs(chars / max(n, 1) - 5.5),
    }
    return n, chars, symbols, dup, repeated, figures


def _votes(figures: dict[str, float]) -> list[int]:
    return [1 if figures[f] <= good else -1 if figures[f] >= bad else 0 for f, good, bad in RULES.values()]


def _measured(batches):
    for pdf in batches:
        rows = []
        for text in pdf["__text"]:
            *base, figures = measure(text)
            rows.append([*base, *_votes(figures)])
        made = pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *[f"v_{r}" for r in RULES]])
        yield pd.concat([pdf[["__key", "__mark"]].reset_index(drop=True), made], axis=1)


def fit(votes: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of good per pattern, and each rule's accuracies on good and on bad texts.

    ``votes``: patterns by rules, 1, -1 or 0; ``weight``: texts per pattern.  A rule's two accuracies
    are how often it says good of a good text and bad of a bad one, when it votes; a rule that says
    good of everything so weighs nothing.  Abstaining says nothing; patterns without any vote get the
    estimated share of good texts.
    """
    weight = weight.astype(float)
    for_good, for_bad = (votes > 0).astype(float), (votes < 0).astype(float)
    voted = for_good + for_bad
    post = np.where(for_bad.any(axis=1), 0.1, 0.9)  # a rule that objects is the first guess
    right_good = right_bad = np.full(votes.shape[1], 0.8)
    for _ in range(ROUNDS):
        good, bad = weight * post, weight * (1 - post)
        right_good = np.clip((good @ for_good + 0.8) / (good @ voted + 1), LEAST, MOST)
        right_bad = np.clip((bad @ for_bad + 0.8) / (bad @ voted + 1), LEAST, MOST)
        prior = np.clip((good.sum() + PRIOR) / (weight.sum() + 1), 0.02, 0.98)
        odds = np.log(prior / (1 - prior)) \
            + for_good @ np.log(right_good / (1 - right_bad)) + for_bad @ np.log((1 - right_good) / right_bad)
        new = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        new = np.where(voted.any(axis=1), new, prior)
        settled = np.abs(new - post).max(initial=0) < 1e-9
        post = new
        if settled:
            break
    return post, right_good, right_bad


def judge(packages: DataFrame, key: str = KEY, text: str = TEXT) -> DataFrame:
    """One row per package: its figures, ``base_failed``, ``p_good``, ``kept`` and ``__mark``.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` (lines with a word, equal to an earlier
    one) and ``n_repeat_words`` (words in three-word windows found twice or more) describe the whole
    text; ``base_failed`` is fewer than ``LEAST_WORDS`` words or more than ``MOST_REPEATED`` % repeated
    words; ``p_good`` is the posterior of its votes, null if failed, estimated over all texts that did
    not fail; ``kept`` is ``p_good >= 0.5``.

    Null or empty text: zero figures, failed.  Null keys stay and repeated rows each keep their row.  An
    empty table gives an empty one.  Other columns are not read.  The measured rows (no texts) are
    written once to the shared folder.
    """
    spark = packages.sparkSession
    plain = keyed(packages, key, text, for_python=True).withColumn("__mark", F.xxhash64("__text"))
    folder = scratch(spark, "votes")
    plain.mapInPandas(_measured, SCHEMA).write.parquet(folder)
    rows = spark.read.schema(SCHEMA).parquet(folder)

    names = [f"v_{r}" for r in RULES]
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    patterns = rows.where(~failed).groupBy(*names).agg(F.count("*").alias("n")).toPandas()  # at most 3 ** len(RULES) rows
    patterns["p_good"] = fit(patterns[names].to_numpy(), patterns["n"].to_numpy())[0]
    found = spark.createDataFrame(patterns[[*names, "p_good"]], ", ".join([*[f"{n} int" for n in names], "p_good double"]))
    rows = restored(rows.withColumnRenamed("__key", key), key, packages)
    return rows.join(F.broadcast(found), names, "left").withColumn("base_failed", failed) \
        .withColumn("p_good", F.when(~F.col("base_failed"), F.col("p_good"))) \
        .select(F.col(f"`{key}`"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                "base_failed", "p_good", F.coalesce(F.col("p_good") >= 0.5, F.lit(False)).alias("kept"), *names, "__mark")


def keep_good(packages: DataFrame, key: str = KEY, text: str = TEXT) -> DataFrame:
    """``packages`` without the rejected ones, columns unchanged."""
    bad = judge(packages, key, text).where("not kept").select(F.col(f"`{key}`").alias("__key"), "__mark").distinct()
    return without(packages, bad, key, text)
