"""From raw documents to training windows, stage by stage.

Each stage takes the documents its predecessor kept and returns documents, the last one the pieces of
training windows.  Between stages the rows are written and read again, so that no stage's work is
repeated and a lost executor costs one stage's tasks at most.
"""

import os

from pyspark.sql import functions as F

from stairfare.llm import contamination, overlap_join, packing, personal_data, quality_votes
from stairfare.sources.tables import scratch

NAMES = {"key": "doc_id", "text": "text"}


def quality(spark, docs, sf_dir):
    """Documents that the quality rules, weighed by their agreement, do not reject."""
    return quality_votes.keep_good(docs, **NAMES)


def near_copies(spark, docs, sf_dir):
    """One document of each group of near-copies: the one whose id is smallest."""
    return overlap_join.keep_one(docs, **NAMES)


def decontaminate(spark, docs, sf_dir):
    """Documents of which windows of the benchmark cover less than a twentieth of the words."""
    benchmark = spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet"))
    return contamination.drop_contaminated(docs, benchmark, **NAMES)


def mask_personal_data(spark, docs, sf_dir):
    """Documents with personal data replaced by its kind; ``n_chars`` follows the text."""
    return personal_data.masked(docs, "text") \
        .withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark, docs, sf_dir):
    """Pieces of training windows: ids as little-endian 32-bit integers, their window and place in it."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), **NAMES)


STAGES = [("quality_rules", quality), ("ngram_jaccard_join", near_copies), ("benchmark_decontamination", decontaminate),
          ("personal_data", mask_personal_data), ("packing", pack)]

#: Neither the estimated rule accuracies nor the packing can be said in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    df = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES[:-1]:
        folder = scratch(spark, f"stage-{name}")
        stage(spark, df, sf_dir).write.parquet(folder)
        df = spark.read.parquet(folder)
    return STAGES[-1][1](spark, df, sf_dir)
