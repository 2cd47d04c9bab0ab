"""Token ids in files for random access: short texts stay small and are found without reading the rest.

One zstandard dictionary, trained on the serialised ids of short texts, is shared by all shards.  Each
text is compressed by itself with it.  A shard holds the frames, then an index with each text's key,
place and id count, then a footer with the index's place and the dictionary's hash, so that a reader
knows whether it has the right dictionary and can seek straight to one text.

Shard layout (little-endian): ``frames | index | footer``.  The index is zstandard-compressed JSON
``{"keys": [...], "ends": [...], "counts": [...]}``; the footer is ``FOOTER`` below.
"""

import json
import struct
import uuid
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import scratch
from . import tokens
from .records import KEY, TEXT, keyed

MAGIC = b"LADTOK01"
#: Magic, hash of the dictionary, place of the index, its length, number of texts.
FOOTER = "<8sQQQQ"
END_ID = 1
#: Texts the dictionary is trained on: so many of at most so many characters, chosen by hash.
DICT_TEXTS, DICT_CHARS, DICT_BYTES, LEVEL = 2_000, 4_000, 64_000, 3


def _files(folder: str):
    """File system and path of a folder named by URL or by path."""
    from pyarrow import fs
    if urlparse(folder).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlparse(folder).path
    return fs.FileSystem.from_uri(folder)


def _hash(dictionary: bytes) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(dictionary)


def train(packages: DataFrame, tokenizer: str, key: str = KEY, text: str = TEXT) -> bytes:
    """Dictionary from at most ``DICT_TEXTS`` short texts; empty if there are too few to train on."""
    short = keyed(packages, key, text).select("__text").where(F.length("__text").between(1, DICT_CHARS)) \
        .withColumn("__h", F.xxhash64("__text"))
    smallest = [r["__h"] for r in short.select("__h").distinct().orderBy("__h").limit(DICT_TEXTS).collect()]
    chosen = short.where(F.col("__h") <= smallest[-1]).dropDuplicates(["__h"]).orderBy("__h").collect() if smallest else []
    samples = tokens.encoder(tokenizer).encode([r["__text"] for r in chosen])
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def _compressor(dictionary: bytes):
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def _decompressor(dictionary: bytes):
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def shard_name(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:06d}.tok"


def _write_shard(folder, dictionary, tokenizer, end_id):
    """Writes the task's texts, already in order, beside the shard's place and moves the file there when whole."""
    def run(batches):
        shard = TaskContext.get().partitionId()
        files, root = _files(folder)
        final = shard_name(root, shard)
        draft = f"{final}.{uuid.uuid4().hex}"
        keys, ends, counts, at = [], [], [], 0
        compress = _compressor(dictionary).compress
        with files.open_output_stream(draft) as out:
            for pdf in batches:
                for k0 in range(0, len(pdf), tokens.TEXTS_AT_ONCE):
                    part = pdf.iloc[k0:k0 + tokens.TEXTS_AT_ONCE]
                    for k, ids in zip(part["__key"].tolist(), tokens.encode_documents(tokenizer, part["__text"].tolist(), end_id)):
                        frame = compress(ids.tobytes())
                        out.write(frame)
                        at += len(frame)
                        keys.append(k)
                        ends.append(at)
                        counts.append(len(ids))
            index = zstandard.compress(json.dumps({"keys": keys, "ends": ends, "counts": counts}).encode())
            out.write(index)
            out.write(struct.pack(FOOTER, MAGIC, _hash(dictionary), at, len(index), len(keys)))
        files.move(draft, final)
        yield pd.DataFrame({"shard": [shard], "n_texts": [len(keys)], "n_tokens": [sum(counts)]})
    return run


def write(packages: DataFrame, tokenizer: str, folder: str | None = None, key: str = KEY, text: str = TEXT,
          shards: int | None = None, end_id: int = END_ID) -> tuple[str, bytes, dict[int, int]]:
    """Writes all texts in ascending key order; folder, dictionary, and the ids of each shard.

    Null keys come first; rows of one key follow each other by their text, repeated rows each keep
    their place.  A null or empty text is the end id alone.  An empty table gives one shard without texts
    or none.  Other columns are not read.  A shard is moved to its place when whole, so a task that
    runs twice leaves one file.  ``folder`` must be one all executors reach; the default is in the shared
    one.  The driver gets three numbers a shard.
    """
    spark = packages.sparkSession
    folder = folder or scratch(spark, "token-files")
    files, root = _files(folder)
    files.create_dir(root, recursive=True)
    dictionary = train(packages, tokenizer, key, text)
    with files.open_output_stream(f"{root}/dictionary.zst") as out:
        out.write(dictionary)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed(packages, key, text).repartitionByRange(shards, F.col("__key").asc_nulls_first(), F.xxhash64("__text")) \
        .sortWithinPartitions(F.col("__key").asc_nulls_first(), F.xxhash64("__text"), "__text") \
        .withColumn("__key", F.col("__key").cast("string"))
    manifest = ordered.mapInPandas(_write_shard(folder, dictionary, tokenizer, end_id), "shard long, n_texts long, n_tokens long").collect()
    return folder, dictionary, {r["shard"]: r["n_tokens"] for r in manifest}


def open_shard(folder: str, shard: int, dictionary: bytes):
    """Random-access file, decompressor and index of a shard; fails on a dictionary that is not its own."""
    files, root = _files(folder)
    f = files.open_input_file(shard_name(root, shard))
    size = f.size()
    f.seek(size - struct.calcsize(FOOTER))
    magic, known, at, length, n = struct.unpack(FOOTER, f.read(struct.calcsize(FOOTER)))
    if magic != MAGIC or known != _hash(dictionary):
        raise ValueError("not a token shard of this dictionary")
    f.seek(at)
    index = json.loads(zstandard.decompress(f.read(length)))
    return f, _decompressor(dictionary), index


def read_text(folder: str, shard: int, dictionary: bytes, nth: int) -> np.ndarray:
    """Ids of the nth text of a shard; only its frame and the index are read."""
    f, d, index = open_shard(folder, shard, dictionary)
    with f:
        start = index["ends"][nth - 1] if nth else 0
        f.seek(start)
        return np.frombuffer(d.decompress(f.read(index["ends"][nth] - start), max_output_size=4 * index["counts"][nth]), "<u4")


def read(spark: SparkSession, folder: str, dictionary: bytes, shard_tokens: dict[int, int], kind: str = "string", key: str = KEY) -> DataFrame:
    """``package_key, start, n_tokens, ids`` of all texts, from the files; ``start`` counts the ids of all texts before."""
    first, total = {}, 0
    for shard in sorted(shard_tokens):
        first[shard] = total
        total += shard_tokens[shard]
    numbers = sorted(first)

    def run(batches):
        for pdf in batches:
            for shard in pdf["id"].tolist():
                shard = numbers[shard]
                f, d, index = open_shard(folder, shard, dictionary)
                start, at = first[shard], 0
                rows = []
                with f:
                    f.seek(0)
                    for k, end, n in zip(index["keys"], index["ends"], index["counts"]):
                        rows.append((k, start, n, d.decompress(f.read(end - at), max_output_size=4 * n)))
                        start, at = start + n, end
                        if len(rows) == 1_000:
                            yield pd.DataFrame(rows, columns=[key, "start", "n_tokens", "ids"])
                            rows = []
                yield pd.DataFrame(rows, columns=[key, "start", "n_tokens", "ids"])

    schema = f"`{key}` string, start long, n_tokens long, ids binary"
    found = spark.range(0, len(numbers), 1, len(numbers)).mapInPandas(run, schema) if numbers else spark.createDataFrame([], schema)
    return found.withColumn(key, F.col(f"`{key}`").cast(kind))
