"""Phrases, piece ids and the draw by likeness, on packages of unit records and on the awkward rows every operator must take."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from stairfare.llm import likeness, phrases, piece_ids, records

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BAGS = ["Cabin bag of eight kilos included, checked bag for a fee. Cabin bag of eight kilos included!",
        "Seat choice for a fee; cabin bag of eight kilos.", "No checked bag\nNo refund, no refund, no refund after departure."]


def packages(spark, descriptions):
    """Package texts of raw unit records, one unit a carrier, and a column named like a helper."""
    brand = "array<struct<raw_brand_name:string,description:string>>"
    units = spark.createDataFrame([(f"{c}|IST|JFK|Summer", [("Economy", [("Light", t) for t in ts])]) for c, ts in descriptions.items()],
                                  f"unit_key string, cabins array<struct<cabin:string,brands:{brand}>>")
    return records.package_texts(units).selectExpr("*", "1 AS n", "'x' AS __group")


def brute_phrases(rows, least, longest, top):
    f, n = Counter(), Counter()
    for g, t in rows:
        g = "und" if g is None else g
        low = (t or "").translate({65 + i: 97 + i for i in range(26)})
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[g] += len(w)
            f.update((g, tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for g in n:
        mine = {p: c for (h, p), c in f.items() if h == g and c >= least}
        scored = []
        for p, a in mine.items():
            if len(p) == 1 or any(len(q) > len(p) and c >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, c in mine.items()):
                continue
            s, _, left, right = min((1000 * a * n[g] // (mine[p[:k]] * mine[p[k:]]), k, mine[p[:k]], mine[p[k:]]) for k in range(1, len(p)))
            scored.append((-s, -a, " ".join(p).encode(), left, right))
        out += [(g, i + 1, p.decode(), -a, left, right, n[g], -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def test_phrases_equal_brute_force(spark):
    rng = random.Random(5)
    made = [" ".join(rng.choice(["bag", "fee", "seat", "Éco", "a", "of", "no,", "to."]) for _ in range(rng.randrange(60))) for _ in range(40)]
    df = packages(spark, {"TK": BAGS * 3 + made, "LH": BAGS + [None, "", " \t. ,", "x" * 40_000, "fee " * 3_000] + made[:20]})
    df = df.unionByName(df.limit(3).withColumn("carrier", F.lit(None).cast("string")))  # a null carrier
    got = sorted(tuple(r) for r in phrases.collocations(df, least=3, top=25).collect())
    assert got == brute_phrases([(r.carrier, r.description) for r in df.collect()], 3, 5, 25)
    assert {r[0] for r in got} == {"TK", "LH", "und"}
    few = sorted(tuple(r) for r in phrases.collocations(df, longest=2, least=4).collect())
    assert few == brute_phrases([(r.carrier, r.description) for r in df.collect()], 4, 2, 2000)
    assert phrases.collocations(df.limit(0)).count() == 0 and phrases.collocations(df, least=10**9).count() == 0


def test_phrase_windows_of_a_long_text_do_not_depend_on_its_tiles(monkeypatch):
    rng = random.Random(6)
    text = "".join(rng.choice(["bag ", "fee", "\tseat", "é ", ".", " no", ", "]) for _ in range(4_000))
    batch = pa.RecordBatch.from_arrays([pa.array([text, "", text[:50]]), pa.array(["TK", "LH", "TK"])], names=["__text", "__group"])
    every = type("Bits", (), {"value": bytes([255]) * (1 << 13)})

    def counted():
        total = Counter()
        for part in phrases._windows(every, every, 1 << 16, 5)([batch]):
            for row in zip(*[c.to_pylist() for c in part.columns]):
                total[row[:-1]] += row[-1]
        return total

    whole = counted()
    for size in (7, 100, 1_001):
        monkeypatch.setattr(phrases, "PASS_BYTES", size)
        assert counted() == whole


def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_piece_ids_equal_the_library():
    rng = random.Random(7)
    texts = ["", " ", "  a", "a  b ", "ab\n c", "▁x", "\x00a", "<s>", "a</s>b", "\r\n\t", "😀é́", *(" " * n for n in range(1, 70)), " " * 20_001 + "x", "a" * 3_000,
             "ab" * 999, "한국어 텍스트 " * 50, "日本語テキスト" * 100, "<0x0A>", "the" * 700, "=-" * 300, "-" * 777, "1234567890" * 9, *BAGS]
    texts += ["".join(rng.choice(" abcdeTthins'.,\n▁éß中") for _ in range(rng.randrange(1, 60))) for _ in range(1500)]
    texts += ["".join(rng.choice("abehtnsior") for _ in range(rng.randrange(1, 500))) for _ in range(200)]
    known, sp = piece_ids.pieces(MODEL), library()
    got, want = known.encode(texts), sp.encode(texts)
    assert [x.tolist() for x in got] == want
    assert [known.decode(x) for x in got] == sp.decode(want)


@pytest.mark.parametrize("ids", [[3, 4], [200, 201], [264, 230, 5], [1, 264], [0, 264], [2, 2, 28705, 264], [229, 134, 299], [243, 200], [28705, 28705], [1, 68, 264], []])
def test_decoding_any_ids_equals_the_library(ids):
    assert piece_ids.pieces(MODEL).decode(np.array(ids, np.int32)) == library().decode(ids)


def test_piece_ids_do_not_depend_on_the_passes(monkeypatch):
    text = " ".join(BAGS) * 20 + "中文字" * 200 + "fee" * 100
    whole = piece_ids.pieces(MODEL).encode([text, "", text[:99]])
    monkeypatch.setattr(piece_ids, "PASS_CHARS", 50)
    assert [list(piece_ids.pieces(MODEL).cut(text, 50))] != [[text]] and "".join(piece_ids.pieces(MODEL).cut(text, 50)) == text
    assert [x.tolist() for x in piece_ids.pieces(MODEL).encode([text, "", text[:99]])] == [x.tolist() for x in whole]


AWKWARD = [(1, BAGS[0]), (2, BAGS[0]), (2, BAGS[0]), (3, None), (4, ""), (None, BAGS[1] * 9), (5, BAGS[2] * 20_000), (6, " \n\t "), (7, "é" * 300), (-8, "x")]


def table(spark, rows):
    return spark.createDataFrame([(k, t, i, "x") for i, (k, t) in enumerate(rows)], "package_key long, description string, n long, __text string")


def test_piece_ids_of_awkward_rows(spark):
    sp = library()
    got = Counter((r.package_key, tuple(r.ids), r.decoded) for r in piece_ids.encode(table(spark, AWKWARD), MODEL).collect())
    assert got == Counter((k, tuple(sp.encode(t or "")), sp.decode(sp.encode(t or ""))) for k, t in AWKWARD)
    assert piece_ids.encode(table(spark, []), MODEL).count() == 0
    assert piece_ids.encode(packages(spark, {"TK": BAGS}), MODEL).columns == ["package_key", "ids", "decoded"]


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({65 + i: 97 + i for i in range(26)}))


def brute_draw(rows, notes, buckets, longest, least, share):
    def hashed(t):
        w = words_of(t)
        return [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, longest + 1) for i in range(len(w) - k + 1)]

    have, want = Counter(b for _, t in rows for b in hashed(t)), Counter(b for t in notes for b in hashed(t))
    a, b = sum(have.values()), sum(want.values())
    out = []
    for k, t in rows:
        f = hashed(t)
        weight = sum(math.floor(1000 * math.log((want[x] + 1) * (a + buckets) / ((have[x] + 1) * (b + buckets)))) for x in f) // max(len(f), 1)
        h = int(hashlib.sha256(f"2024:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        out.append((k, len(words_of(t)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0]))
    ranked = [(*r, i + 1 if i < share * len(fit) // 100 else None) for i, r in enumerate(fit)]
    return Counter(ranked + [(*r, None) for r in out if r[1] < least])


@pytest.mark.parametrize("longest, least, share", [(1, 20, 10), (2, 3, 60), (3, 0, 100)])
def test_draw_equals_brute_force(spark, longest, least, share):
    rng = random.Random(8)
    rows = AWKWARD + [(100 + i, " ".join(rng.choice(["Bag", "fee", "seat,", "éco", "refund", "x1"]) for _ in range(rng.randrange(60)))) for i in range(80)]
    notes = [BAGS[2], None, "", "Refund fee, refund; seat"]
    df = spark.createDataFrame([(t, 1) for t in notes], "Note string, n int").withColumnRenamed("Note", "description")
    got = likeness.draw_like(table(spark, rows), df, buckets=997, longest=longest, least_words=least, share=share).collect()
    assert Counter(tuple(r) for r in got) == brute_draw(rows, notes, 997, longest, least, share)


def test_draw_without_rows_or_notes(spark):
    empty = spark.createDataFrame([], "package_key long, description string")
    assert likeness.draw_like(empty, empty).count() == 0
    assert likeness.draw_like(table(spark, AWKWARD), empty).count() == len(AWKWARD)
    got = likeness.draw_like(packages(spark, {"TK": BAGS}), records.note_texts(spark.createDataFrame(
        [("TK", "IST", "JFK", "Summer", "Economy", "Light", "bag for a fee")], "Carrier string, Origin string, Destination string, Season string, Cabin string, `Brand Name` string, Note string")))
    assert got.columns[0] == "package_key" and got.count() == 3


def test_features_of_a_long_text_do_not_depend_on_its_tiles(monkeypatch):
    texts = pa.array([", ".join(BAGS) * 9, "", "fee"])
    want = [Counter(zip(*(x.tolist() for x in likeness.features(texts, 101, 3)[1:]))), likeness.features(texts, 101, 3)[0].tolist()]
    monkeypatch.setattr(likeness, "PASS_BYTES", 13)
    assert [Counter(zip(*(x.tolist() for x in likeness.features(texts, 101, 3)[1:]))), likeness.features(texts, 101, 3)[0].tolist()] == want
