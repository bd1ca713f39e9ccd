"""Best-fit packing planned on the histogram of lengths.

The plan never sees a document: best-fit decreasing runs over (length, count)
pairs on the driver, at most ``capacity`` of them, and hands out ranges of
slots.  Pieces are ranked within their length and take the slot of their rank
by an equi-join.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.llm.bpe import byte_letters
from pulsekit.llm.common import landed, per_process

CAPACITY = 4096
END_ID = 1
#: Words above this length are encoded each time instead of being remembered.
LONGEST_CACHED, MAX_CACHED = 48, 1 << 20
#: Words that no rule of the splitter cuts and that normalisation only lower-cases.
PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: ASCII punctuation after a letter, up to the end of the word, is one piece of the splitter.  The
#: signs of special tokens are left out, and the apostrophe, which joins letters after it.
TAIL = re.compile(rb"(.*[A-Za-z])([!-&(-/:;=?@\[-`{}~]+)", re.DOTALL)
SLOT_CHUNK = 1 << 16


class WordEncoder:
    """Token ids of a text as little-endian 32-bit integers, remembered by word.

    The tokenizer drops white space before it splits and ignores case, so the ids
    of a text are those of its lower-case words one after another.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok, self.known = Tokenizer.from_file(path), {}
        self.tok.no_truncation()
        self.tok.no_padding()
        self.bare = Tokenizer(self.tok.model)  # the merges without normalisation and splitting
        self.letters = str.maketrans({chr(b): c for b, c in byte_letters().items()})
        self.ends = np.zeros(self.tok.get_vocab_size(), bool)
        self.ends[[i for t, i in self.tok.get_vocab().items() if t.endswith("</w>")]] = True

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """A word of Latin letters alone is one token of the splitter: the merges suffice."""
        texts = [w.decode("utf-8") for w in words]
        plain = [bool(PLAIN.fullmatch(t)) for t in texts]
        parts = [t.lower().encode("utf-8").decode("latin-1").translate(self.letters)
                 for t, p in zip(texts, plain) if p]
        ids = np.array(self.bare.encode(parts, is_pretokenized=True, add_special_tokens=False).ids, "<u4") if parts \
            else np.empty(0, "<u4")
        raw, at = ids.tobytes(), [0, *(4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()]
        if len(at) != len(parts) + 1:
            raise ValueError("a word's last token is not marked as the end of a word")
        merged = iter([raw[a:b] for a, b in zip(at, at[1:])])
        other = iter(self.tok.encode_batch_fast([t for t, p in zip(texts, plain) if not p], add_special_tokens=False))
        return [next(merged) if p else array("I", next(other).ids).tobytes() for p in plain]

    def _learn(self, words: set[bytes]) -> list[bytes]:
        """A word that ends in punctuation is its stem's ids and then its tail's; both serve other words too.

        Returns what is to be forgotten after use.
        """
        known = self.known
        cuts = {w: m.groups() for w in words if (m := TAIL.fullmatch(w))}
        new = list(words.difference(cuts).union(*cuts.values()).difference(known))
        known.update(zip(new, self._ids(new)))
        known.update((w, known[stem] + known[tail]) for w, (stem, tail) in cuts.items())
        return [w for w in {*new, *words} if len(w) > LONGEST_CACHED]

    def encode(self, text: str | None) -> bytes:
        raw = (text or "").encode("utf-8")
        words = (raw if b"<|" in raw else raw.lower()).split()  # special tokens are found before the case goes
        known = self.known
        if len(known) > MAX_CACHED:
            known.clear()
        ids = list(map(known.get, words))
        if None in ids:
            long = self._learn(set(words).difference(known))
            ids = list(map(known.__getitem__, words))
            for w in long:
                del known[w]
        return b"".join(ids)


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
               keep_ids: bool = False) -> DataFrame:
    """-> (doc_id, piece, start, length, ids_crc32[, ids]): every document's ids plus ``end_id``, cut if too long.

    A null text is empty and gives the one id ``end_id``.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * keep_ids
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids

    def cut(batches):
        encoder = per_process(("words", tokenizer_path), lambda: WordEncoder(tokenizer_path))
        end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encoder.encode(text) + end
                for k in range(0, len(ids), step):
                    part = ids[k:k + step]
                    rows.append((doc, k // step, k // 4, len(part) // 4, zlib.crc32(part))
                                + ((np.frombuffer(part, "<i4"),) if keep_ids else ()))
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


def plan_slots(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Best-fit decreasing over counts.

    -> rows (length, first rank, ranks, items per sequence, first sequence, offset) and the number of
    sequences.  Equal open sequences are kept as one range, so the work depends on the number of
    different lengths.  An item goes to the open sequence with the least room that fits; since that
    stays the tightest one, it takes as many items of the length as it can hold.
    """
    groups: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> ranges of sequences
    rooms: list[int] = []  # rooms in use, ascending
    rows, sequences = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        if left <= 0:
            continue
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is outside 1 to {capacity}")
        moved: list[tuple[int, int, int]] = []

        def fill(first: int, n: int, room: int) -> None:
            """Put items of the length into n sequences with this room."""
            nonlocal left, rank
            per = room // length
            full = min(n, left // per)
            for first_, n_, items in ((first, full, per), (first + full, min(1, n - full), left - full * per)):
                if n_ and 0 < items:
                    items = min(items, per)
                    rows.append((length, rank, n_ * items, items, first_, capacity - room))
                    moved.append((room - items * length, first_, n_))
                    rank, left = rank + n_ * items, left - n_ * items

        for room in [r for r in rooms if r >= length]:
            ranges = groups[room]
            while ranges and left:
                first, n = ranges.pop()
                before = left
                fill(first, n, room)
                used = min(n, -(-before // (room // length)))
                if used < n:
                    ranges.append((first + used, n - used))
            if not left:
                break
        if left:
            need = -(-left // (capacity // length))
            first, sequences = sequences, sequences + need
            fill(first, need, capacity)
        for room, first, n in moved:
            groups[room].append((first, n))
        rooms = sorted(r for r in groups if r and groups[r])
    return rows, sequences


def ranked(pieces: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds ``rank``: 0, 1, ... within each length.

    A length that holds a large share of all pieces is ranked in about the square root of its count
    parts, whose starts are the running sum of the parts' sizes.
    """
    parts = F.broadcast(counts.select("length", F.floor(F.sqrt("count")).cast("long").alias("parts")))  # one row a length
    split = (pieces.join(parts, "length")
             .withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("parts"))).drop("parts"))
    sizes = split.groupBy("length", "part").agg(F.count("*").alias("size"))
    before = (Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("length", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    return (split.withColumn("k", F.row_number().over(within)).join(starts, ["length", "part"])
            .withColumn("rank", F.col("before") + F.col("k") - 1).drop("k", "before", "part"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of at most ``capacity`` tokens.

    Sequences are gapless from offset 0.  Which of several pieces of one length gets which slot
    follows a hash and then (doc_id, piece), so repeated rows each get their own.  An empty table
    gives no sequence.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("length").agg(F.count("*").alias("count"))
    histogram = {r["length"]: r["count"] for r in counts.toLocalIterator()}  # at most `capacity` rows
    rows, _ = plan_slots(histogram, capacity)
    plan = spark.createDataFrame(rows, "length long, first long, ranks long, per long, sequence long, offset long")
    known = spark.createDataFrame(list(histogram.items()), "length long, count long")
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.col("ranks") - 1, F.lit(SLOT_CHUNK).cast("long"))).alias("c")
    slot = F.explode(F.sequence("c", F.least(F.col("c") + SLOT_CHUNK, F.col("ranks")) - 1)).alias("r")
    slots = (plan.select("*", chunk).repartition("length", "first", "c").select("*", slot)
             .select("length", (F.col("first") + F.col("r")).alias("rank"),
                     (F.col("sequence") + F.expr("r div per")).alias("sequence_id"),
                     (F.col("offset") + F.col("r") % F.col("per") * F.col("length")).alias("offset")))
    return ranked(pieces, known).join(slots, ["length", "rank"]).drop("rank")


def best_fit_packing(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                     keep_ids: bool = False) -> DataFrame:
    """(doc_id, text, ...) -> one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids].

    A document is the ids of its whole text plus ``end_id``; only documents longer than ``capacity``
    are cut.  A null text is empty; a null doc_id is kept; repeated rows are packed each; an empty
    table gives an empty result; other columns are not read.
    """
    pieces = landed(cut_pieces(docs, tokenizer_path, capacity, end_id, keep_ids), "pieces")
    out = pack(pieces, capacity)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
                      *["ids"] * keep_ids)
