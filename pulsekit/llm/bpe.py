"""Byte-level BPE, encoded with a queue of merges over a linked list of symbols."""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import per_process

#: Fixed: how byte-level vocabularies cut a text before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONGEST_CACHED, MAX_CACHED = 64, 1 << 20


def byte_letters() -> dict[int, str]:
    """Fixed: the printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class BytePairCodec:
    """Encodes and decodes with the merges and the vocabulary of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letter = byte_letters()
        back = {c: b for b, c in letter.items()}
        self.first = [vocab[letter[b]] for b in range(256)]
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a], vocab[b]] = rank, vocab[a + b]
        self.strings = {i: bytes(back[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.strings |= {i: t.encode() for t, i in self.special.items()}
        marks = "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self.marks = regex.compile(f"({marks})") if marks else None
        self.cut = regex.compile(PATTERN)
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token: the best-ranked, then leftmost merge first."""
        ids = [self.first[b] for b in data]
        n, merges = len(ids), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            if m := merges.get((ids[i], ids[i + 1])):
                queue.append((m[0], i, m[1], ids[i], ids[i + 1]))
        heapq.heapify(queue)
        while queue:
            _, i, new, a, b = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # stale: one of the two was merged meanwhile
            k = after[j]
            ids[i], ids[j], after[i] = new, -1, k
            if k < n:
                before[k] = i
                if m := merges.get((new, ids[k])):
                    heapq.heappush(queue, (m[0], i, m[1], new, ids[k]))
            h = before[i]
            if h >= 0 and (m := merges.get((ids[h], new))):
                heapq.heappush(queue, (m[0], h, m[1], ids[h], new))
        return [x for x in ids if x >= 0]

    def piece(self, token: str) -> tuple[bytes, bytes]:
        """(ids as little-endian 32-bit integers, their vocabulary strings) of a pre-token."""
        found = self.known.get(token)
        if found is None:
            ids = self.merge(token.encode("utf-8"))
            found = np.array(ids, "<u4").tobytes(), self.decode_bytes(ids)
            if len(token) <= LONGEST_CACHED:
                if len(self.known) >= MAX_CACHED:
                    self.known.clear()
                self.known[token] = found
        return found

    def both(self, text: str | None) -> tuple[bytes, bytes]:
        """(ids as little-endian 32-bit integers, their vocabulary strings) of a whole text."""
        found = []
        for i, part in enumerate(self.marks.split(text or "") if self.marks else [text or ""]):
            if i % 2:
                found.append((np.array([self.special[part]], "<u4").tobytes(), part.encode()))
            else:
                found += map(self.piece, self.cut.findall(part))
        return b"".join([p[0] for p in found]), b"".join([p[1] for p in found])

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.both(text)[0], "<u4")

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.strings.__getitem__, ids))

    def decode(self, ids) -> str:
        """The text of the ids; ids outside the vocabulary are an error, bytes that are no UTF-8 become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


def bpe_encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, text, ...) -> (doc_id, ids, decoded): ids of the whole text and the text decoded from them.

    A null text is empty, an empty text has no ids; rows with null or repeated doc_id are kept each;
    special tokens' strings in a text become their ids; other columns are not read.
    """
    def encode(batches):
        codec = per_process(("bytes", path), lambda: BytePairCodec(path))
        for batch in batches:
            ids = [codec.encode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())),
                 pa.array([codec.decode(x.tolist()) for x in ids], pa.string())], ["doc_id", "ids", "decoded"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(encode, "doc_id long, ids array<int>, decoded string"))


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """As ``bpe_encode`` with digests in place of the ids and the decoded text:
    (doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    def encode(batches):
        codec = per_process(("bytes", path), lambda: BytePairCodec(path))
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                ids, strings = codec.both(text)
                decoded = strings.decode("utf-8", "replace").encode("utf-8")
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            n, a, b = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(encode, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))
