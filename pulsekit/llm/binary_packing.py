"""Power-of-two decomposition: documents cut into pieces of binary lengths, equal lengths in one bucket.

A document of n tokens gives one piece for every binary digit of n below the longest length, longest
first, and n div longest pieces of that length.  Each piece is a sequence of its own: none crosses
documents, none is padded, and a batch drawn from one bucket is rectangular.
"""

from __future__ import annotations

import json
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.llm.bpe import PATTERN, BytePairCodec, byte_letters
from pulsekit.llm.common import landed, per_process

LONGEST = 1024
END_ID = 0


class ByteEncoder:
    """Token ids of whole texts by the merges of a byte-level tokenizer file.

    The merges are run as ranks of byte strings, which needs the vocabulary to number them in the order
    of the merges; a file of another kind is an error.  A text on which that library gives up (white space
    runs of megabytes) goes through the queue of ``BytePairCodec``.
    """

    def __init__(self, path: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = {c: b for b, c in byte_letters().items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        merged = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in spec["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError(f"{os.path.basename(path)}: ids do not follow the order of the merges")
        ranks = {bytes(back[c] for c in t): i for t, i in vocab.items()}
        self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.path, self.slow = path, None

    def encode(self, text: str | None) -> np.ndarray:
        try:
            return np.asarray(self.fast.encode(text or "", allowed_special="all"), "<u4")
        except ValueError:
            self.slow = self.slow or BytePairCodec(self.path)
            return self.slow.encode(text)


def binary_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Lengths of the pieces of n tokens: as many of ``longest`` as fit, then the binary digits of the rest."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


def binary_pieces(docs: DataFrame, tokenizer_path: str, longest: int = LONGEST, end_id: int = END_ID,
                  keep_ids: bool = False) -> DataFrame:
    """-> (doc_id, start, length, ids_crc32, doc_tokens[, ids]): one row per piece of every document.

    A null text is empty and gives the one id ``end_id``; ``longest`` is a power of two.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError(f"{longest} is no power of two")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids
    types = [pa.int64()] * 5 + [pa.list_(pa.int32())] * keep_ids
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids

    def cut(batches):
        encoder = per_process(("byte ids", tokenizer_path), lambda: ByteEncoder(tokenizer_path))
        end = np.array([end_id], "<u4")
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids, start = np.concatenate([encoder.encode(text), end]), 0
                for length in binary_lengths(len(ids), longest):
                    part = ids[start:start + length]
                    rows.append((doc, start, length, zlib.crc32(part.tobytes()), len(ids))
                                + ((part.astype("<i4"),) if keep_ids else ()))
                    start += length
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


def bucketed(pieces: DataFrame) -> DataFrame:
    """Adds ``bucket`` (the exponent of the length), ``sequence_id`` and ``offset`` to pieces of binary lengths.

    Sequences are numbered from 0, bucket after bucket, so each bucket is one range of numbers.  A bucket is
    numbered in about the square root of its size parts, dealt by a hash, whose starts are the running sum of
    the parts before; equal rows get numbers of their own.
    """
    spark = pieces.sparkSession
    marked = pieces.withColumn("bucket", F.floor(F.log2("length") + 0.5).cast("int"))
    counted = marked.groupBy("bucket").agg(F.count("*").alias("n")).orderBy("bucket").collect()  # one row a bucket
    parts = spark.createDataFrame([(r.bucket, max(1, int(r.n ** 0.5))) for r in counted], "bucket int, parts long")
    split = (marked.join(F.broadcast(parts), "bucket")
             .withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("parts"))).drop("parts"))
    sizes = split.groupBy("bucket", "part").agg(F.count("*").alias("size"))
    earlier = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first, firsts = 0, []
    for r in counted:
        firsts.append((r.bucket, first))
        first += r.n
    base = spark.createDataFrame(firsts, "bucket int, first long")
    starts = (sizes.withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
              .join(F.broadcast(base), "bucket").select("bucket", "part", (F.col("first") + F.col("before")).alias("before")))
    within = Window.partitionBy("bucket", "part").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    return (split.withColumn("k", F.row_number().over(within)).join(starts, ["bucket", "part"])
            .withColumn("sequence_id", F.col("before") + F.col("k") - 1)
            .withColumn("offset", F.lit(0).cast("long")).drop("part", "before", "k"))


def binary_packing(docs: DataFrame, tokenizer_path: str, longest: int = LONGEST, end_id: int = END_ID,
                   keep_ids: bool = False) -> DataFrame:
    """(doc_id, text, ...) -> one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    bucket[, ids].

    A document is the ids of its whole text plus ``end_id``.  A null text is empty; a null doc_id is kept;
    repeated rows are packed each; an empty table gives an empty result; other columns are not read.
    """
    pieces = landed(binary_pieces(docs, tokenizer_path, longest, end_id, keep_ids), "binary-pieces")
    return bucketed(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                                   "bucket", *["ids"] * keep_ids)
