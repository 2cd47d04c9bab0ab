"""Toxicity of free text from subword bags: misspelt and inflected insults share character n-grams.

A word is the mean of the vectors of its character n-grams (hashed into a table); a stretch of ``SPAN``
words is the mean of its words' vectors and goes through a linear softmax.  Vectors and softmax are trained
together in numpy.  A text is as toxic as its most toxic stretch, in training too, so one insult in a
long text is not averaged away.
"""

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .records import KEY, TEXT, keyed, restored

ROWS, DIM, SPAN = 1 << 16, 12, 6
NGRAMS = (3, 4, 5, 6)
#: Labelled texts the model is fitted on, at most, chosen by hash; each is read whole.
FIT_TEXTS = 4_000
EPOCHS, RATE, SEED = 12, 0.5, 11
_WORD = re.compile(r"[^\W\d_]+")
_KNOWN: dict[str, np.ndarray] = {}


def grams(word: str) -> np.ndarray:
    """Table rows of a word's n-grams, word boundaries marked."""
    got = _KNOWN.get(word)
    if got is None:
        w = f"<{word[:40]}>" if len(word) <= 40 else f"<{word}>"
        parts = {w[i:i + n] for n in NGRAMS for i in range(len(w) - n + 1)} or {w}
        got = np.fromiter((zlib.crc32(p.encode()) % ROWS for p in sorted(parts)), np.int64, len(parts))
        if len(_KNOWN) > 300_000:
            _KNOWN.clear()
        _KNOWN[word] = got
    return got


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _span_means(word_values: np.ndarray) -> np.ndarray:
    """Means over consecutive stretches of ``SPAN`` words (half overlapping), one at least."""
    n = len(word_values)
    starts = np.arange(0, max(n - SPAN // 2, 1), SPAN // 2)
    sums = np.concatenate([np.zeros((1, *word_values.shape[1:])), np.cumsum(word_values, axis=0)])
    ends = np.minimum(starts + SPAN, n)
    return (sums[ends] - sums[starts]) / (ends - starts).reshape(-1, *[1] * (word_values.ndim - 1))


def fit(texts: list[str], labels: np.ndarray) -> dict[str, np.ndarray]:
    """Vectors, weights and bias; the stretch that decides a text is found anew each epoch."""
    rng = np.random.default_rng(SEED)
    table = (rng.standard_normal((ROWS, DIM)) * 0.1).astype(np.float32)
    weight, bias = (rng.standard_normal(DIM) * 0.1).astype(np.float32), np.float32(-1.0)
    number: dict[str, int] = {}
    docs = [np.array([number.setdefault(w, len(number)) for w in words_of(t)], np.int64) for t in texts]
    own = [grams(w) for w in number]
    sizes = np.array([len(g) for g in own], np.int64)
    firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if own else np.empty(0, np.int64)
    flat = np.concatenate(own) if own else np.empty(0, np.int64)
    y = labels.astype(np.float32)
    share = float(np.clip(y.mean() if len(y) else 0.5, 0.05, 0.95))
    rate_of = {1.0: RATE * 0.5 / share, 0.0: RATE * 0.5 / (1 - share)}
    g_table, g_weight, g_bias = np.full(ROWS, 1e-6), np.full(DIM, 1e-6), 1e-6
    for _ in range(EPOCHS if own else 0):
        # words scored with the epoch's start values choose the stretch; its gradient is exact
        word_score = np.add.reduceat((table @ weight)[flat], firsts) / sizes
        for d in rng.permutation(len(docs)):
            if not len(docs[d]):
                continue
            best = int(_span_means(word_score[docs[d]]).argmax()) * (SPAN // 2)
            span = docs[d][best:best + SPAN]
            rows = np.concatenate([own[w] for w in span])
            part = np.repeat(1.0 / (sizes[span] * len(span)), sizes[span]).astype(np.float32)
            x = part @ table[rows]
            p = 1 / (1 + np.exp(-np.clip(10 * (x @ weight) + bias, -30, 30)))
            err = (p - y[d]) * rate_of[float(y[d])]
            grad_row = 10 * err * weight
            g_weight += (10 * err * x) ** 2
            g_bias += err * err
            new_weight = weight - 0.5 * 10 * err * x / np.sqrt(g_weight)
            np.add.at(g_table, rows, part ** 2 * float(grad_row @ grad_row))
            np.add.at(table, rows, -(0.5 * part / np.sqrt(g_table[rows]))[:, None] * grad_row)
            weight, bias = new_weight.astype(np.float32), np.float32(bias - 0.2 * err / np.sqrt(g_bias))
    return {"row_score": (10 * (table @ weight)).astype(np.float32), "bias": np.array([bias], np.float32)}


def score_text(text: str, model: dict[str, np.ndarray], memo: dict[str, float] | None = None) -> float:
    """Probability of toxic of the most toxic stretch; a text without words has that of the bias alone.

    The softmax is linear, so a row's vector enters only through its product with the weights.
    """
    ws = words_of(text)
    bias = float(model["bias"][0])
    if not ws:
        return float(1 / (1 + np.exp(-min(bias, 0.0))) * 0.999)
    memo = {} if memo is None else memo
    row_score = model["row_score"]
    for w in set(ws):
        if w not in memo:
            memo[w] = float(row_score[grams(w)].mean())
    values = np.fromiter(map(memo.__getitem__, ws), np.float64, len(ws))
    z = float(np.clip(_span_means(values).max() + bias, -30, 30))
    return 1 / (1 + np.exp(-z))


def held_out(key: Column) -> Column:
    """Rows no label is learnt from."""
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


def train(packages: DataFrame, labels: DataFrame, key: str = KEY, text: str = TEXT, label: str = "toxic") -> dict[str, np.ndarray]:
    """Model from at most ``FIT_TEXTS`` labelled texts outside the held-out rows, chosen by hash, classes alike."""
    known = labels.select(F.col(f"`{key}`").alias("__lkey"), F.col(f"`{label}`").cast("int").alias("__y")) \
        .where("__y is not null and __lkey is not null").groupBy("__lkey").agg(F.max("__y").alias("__y"))
    known = known.where(~F.coalesce(held_out(F.col("__lkey")), F.lit(True))).withColumn("__h", F.xxhash64("__lkey"))
    half = FIT_TEXTS // 2
    picked = None
    for y in (0, 1):  # two bounded lists of keys, before any text is read
        one = known.where(F.col("__y") == y).orderBy("__h", "__lkey").limit(half)
        picked = one if picked is None else picked.unionByName(one)
    rows = keyed(packages, key, text).join(F.broadcast(picked), F.col("__key") == F.col("__lkey")) \
        .select("__h", "__y", "__text").orderBy("__h", "__text").limit(2 * FIT_TEXTS).collect()
    return fit([r["__text"] for r in rows], np.array([r["__y"] for r in rows]))


def score(packages: DataFrame, model: dict[str, np.ndarray], key: str = KEY, text: str = TEXT) -> DataFrame:
    """One row per package: ``package_key, held_out, score, predicted``.

    ``score`` is the probability of toxic, ``predicted`` 1 from 0.5 on, ``held_out`` whether labels of the row
    are never learnt from.  Null or empty text: the score of no words.  Null keys stay and count as held
    out; repeated rows each keep their row.  An empty table gives an empty one; other columns are not read.
    Whole texts are scored, each distinct word once a task.
    """
    def run(batches):
        memo: dict[str, float] = {}
        for pdf in batches:
            if len(memo) > 500_000:
                memo.clear()
            yield pd.DataFrame({key: pdf["__key"], "score": [score_text(t, model, memo) for t in pdf["__text"]]})

    scored = keyed(packages, key, text, for_python=True).mapInPandas(run, f"`{key}` string, score double")
    return restored(scored, key, packages).select(
        F.col(f"`{key}`"), F.coalesce(held_out(F.col(f"`{key}`")), F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
