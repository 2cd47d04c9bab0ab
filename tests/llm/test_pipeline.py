"""The pipeline on a few documents: every stage's decision takes effect, awkward rows pass, windows hold all that is kept."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from stairfare.llm import tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
GOOD = [" ".join(f"Word{j * (i + 3) % 97} is fine." for j in range(60)) for i in range(12)]
ITEM = "the quick brown fox jumps over a lazy dog while seven wise men look on and the river runs past the old mill"


@pytest.fixture
def folder(spark, tmp_path):
    def write(rows):
        spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
        spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
        return str(tmp_path)
    return write


def doc(i, text):
    return (i, text, "en", "s", None if text is None else len(text))


def test_every_decision_takes_effect(spark, folder):
    secret = GOOD[8] + " write ali@example.org today"
    rows = [doc(i, t) for i, t in enumerate(GOOD[:8])] + [doc(20, GOOD[0]), doc(21, GOOD[0] + " More."), doc(21, GOOD[0] + " More."), doc(30, GOOD[9] + " " + (ITEM + " ") * 3),
            doc(31, secret), doc(40, None), doc(41, ""), doc(42, "few words"), doc(43, "same same same same " * 60), doc(None, GOOD[10])]
    path = folder(rows)
    pieces = corpus_pipeline.run(spark, path).collect()
    whole = {}
    for p in sorted(pieces, key=lambda p: p.start):
        whole.setdefault(p.doc_id, []).append(p.ids)
    kept = dict(enumerate(GOOD[:8])) | {31: secret.replace("ali@example.org", "[EMAIL]"), None: GOOD[10]}
    want = {k: tokens.encode_documents(public_tokenizers.path("byte_bpe_50k.json"), [t], 1)[0].tobytes() for k, t in kept.items()}
    assert {k: b"".join(parts) for k, parts in whole.items()} == want
    sizes = Counter()
    for p in pieces:
        sizes[p.sequence_id] += p.length
    assert all(n == 2048 or n & (n - 1) == 0 for n in sizes.values())
    assert sum(sizes.values()) == sum(len(np.frombuffer(x, "<u4")) for x in want.values())


def test_an_empty_table_gives_no_window(spark, folder):
    assert corpus_pipeline.run(spark, folder([])).count() == 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "benchmark_decontamination", "personal_data", "packing"]
