"""The registered queries: thin steps from the given tables to the operators and back."""

import os

from pyspark.sql import DataFrame, functions as F

from . import (contamination, dialogues, likeness, overlap_join, packing, page_text, personal_data, phrases, piece_ids, quality_votes, repeats, token_files,
               toxicity)
from .records import KEY, TEXT

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark, sf_dir, name) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _documents(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(F.col("doc_id").alias(KEY), F.col("text").alias(TEXT))


def _vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_pack(spark, sf_dir):
    pieces = packing.pack(_documents(spark, sf_dir), _vocabulary("byte_bpe_50k.json"))
    return pieces.select(F.col(KEY).alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op2_token_files(spark, sf_dir):
    folder, dictionary, shards = token_files.write(_documents(spark, sf_dir), _vocabulary("word_bpe_49k.json"))
    stored = token_files.read(spark, folder, dictionary, shards, kind="bigint")
    return stored.select(F.col(KEY).alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op3_shingle_links(spark, sf_dir):
    linked = overlap_join.link(_documents(spark, sf_dir))
    return linked.select(F.col(KEY).alias("doc_id"), "n_shingles", F.col("component_key").alias("component_id"))


def _listed(spans: str):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query
def op4_personal_data(spark, sf_dir):
    found = personal_data.find(_documents(spark, sf_dir))
    return found.select(F.col(KEY).alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2(_listed("base_spans"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


@query
def op5_repeats(spark, sf_dir):
    cut = repeats.remove_repeats(_documents(spark, sf_dir))
    return cut.select(F.col(KEY).alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op6_chat_format(spark, sf_dir):
    """Conversation -7 is the contract's own: both its texts consist of control strings."""
    vocabulary = _vocabulary("byte_bpe_50k.json")
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], given.schema)
    formatted = dialogues.format_turns(given.unionByName(own), vocabulary)
    back = dialogues.read_back(formatted, vocabulary)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


@query
def op7_decontaminate(spark, sf_dir):
    found = contamination.overlap(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))
    return found.select(F.col(KEY).alias("doc_id"), "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query
def op8_page_text(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    texts = page_text.extract(pages.select("page_id", "url", "html"), page_text.train(pages), carry=("url",))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op9_toxicity(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias(KEY), "toxic")
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select(F.col(KEY).alias("doc_id"), "held_out", "score", "predicted")


@query
def op10_quality_votes(spark, sf_dir):
    judged = quality_votes.judge(_documents(spark, sf_dir))
    return judged.select(F.col(KEY).alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op11_phrases(spark, sf_dir):
    """The carriers of the descriptions are the languages here."""
    texts = _table(spark, sf_dir, "documents").select(F.col("text").alias(TEXT), F.col("lang").alias("carrier"))
    return phrases.collocations(texts).withColumnRenamed("carrier", "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@query
def op12_piece_ids(spark, sf_dir):
    encoded = piece_ids.encode(_documents(spark, sf_dir), _vocabulary("piece_bpe_32k.model"))
    return encoded.select(F.col(KEY).alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op13_draw_like(spark, sf_dir):
    """The wanted texts are the benchmark's."""
    wanted = _table(spark, sf_dir, "benchmark").select(F.col("text").alias(TEXT))
    drawn = likeness.draw_like(_documents(spark, sf_dir), wanted)
    return drawn.select(F.col(KEY).alias("doc_id"), "n_features", "weight", "score", "rank")
