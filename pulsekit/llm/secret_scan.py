"""Secret scan: fixed patterns, and guess costs of values in credential contexts."""

from __future__ import annotations

import hashlib
import json
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed: kinds and patterns of the base scan, in the order of the kinds.
ASSIGN = re.compile(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
                    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "guess")
#: Words one of which stands in every match of ASSIGN, in lower case.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Credential contexts of the guess-cost rule, a superset of the base ones.  A quoted value runs to its closing
#: quote; another one to white space or a quote, without signs at its end, a next key or markup after it.
CONTEXT = re.compile(
    r"(?<![A-Za-z0-9])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key"
    r"|client[_ -]?secret|credentials?|auth[_ -]?key)[\"']?[\x20\t]{0,8}(?::=|=>|[:=])[\x20\t]{0,8}"
    r"(?:\"((?:[^\"\\\r\n]|\\.)++)\"|'((?:[^'\\\r\n]|\\.)++)'|[\"']?((?:[^\s\"'<>,;(){}\[\]]++"
    r"|[<>,;(){}\[\]]++(?!(?<=[,;])[\w.-]{1,40}[\x20\t]?[:=]|(?<=<)(?:/|!--|[a-z]\w{0,20}[\s/>]))(?=[^\s\"'<>,;(){}\[\]]))++))",
    re.ASCII | re.IGNORECASE)
MIN_LENGTH = 8
CONTEXT_WORDS = ("pass", "pwd", "secret", "token", "key", "credential")

#: Rows of a keyboard; neighbours in a row make a walk.
KEY_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
#: Letters that digits and signs often stand for.
LEET = str.maketrans({"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?"
                  r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d")
MIN_COST = 11.0  # decimal digits of guesses
#: Fixed: what stands for a value that is filled in elsewhere: ${NAME}, $NAME, {{name}}, <name>, %(name)s, %NAME%, ****, xxxx.
PLACEHOLDER = re.compile(r"\$\{[^{}\n]*\}|\$[A-Za-z_]\w*|\{\{[^{}\n]*\}\}|<[^<>\n]+>|%\([^()\n]*\)s?|%\w+%|([*xX.#])\1{3,}")
#: Paths, addresses and calls; their parts are words.
LISTED = re.compile(r"(?:[a-z][a-z0-9+.-]*://|\.{0,2}/|~/|[a-z]:\\)\S+|[a-z_]\w*(?:\.\w+)*\([^()]*\)?", re.ASCII | re.IGNORECASE)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9A-Za-z]+?(?=[A-Z][a-z])|[^\W_]+")
#: A sentence, path or call of dictionary words costs as much as an entry of a list; words up to this rank make sentences.
LIST_COST, FUNCTION_RANK = 6.0, 200
CLOSING = {")": "(", "]": "["}


def word_ranks(vocabulary: str) -> dict[str, int]:
    """Whole words of a vocabulary file with their rank: merges come in order of frequency."""
    with open(vocabulary, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    words = (t[:-4] for t in sorted(vocab, key=vocab.get) if t.endswith("</w>"))
    return {w: i + 1 for i, w in enumerate(w for w in words if len(w) > 2 and w.isascii() and w.isalpha())}


def alphabet(value: str) -> int:
    """26 for letters of one case or digits alone, 62 for a mix of them, 95 with other signs."""
    if not value.isalnum():
        return 95
    kinds = any(c.isdigit() for c in value) + (value != value.lower()) + (value != value.upper())
    return 62 if kinds > 1 else 26


class GuessCost:
    """Decimal logarithm of the guesses an attacker needs, over the cheapest segmentation of a value.

    A value is cut into dictionary words (also capitalised or with digits for letters), dates, repeats,
    keyboard walks and sequences; a character that remains costs the logarithm of the alphabet that the
    value draws on, times ``brute``.  Sentences, paths, addresses and calls are entries of a list, and only
    their parts outside the dictionary cost more.  Linear in the value's length.
    """

    def __init__(self, ranks: dict[str, int], brute: float = 1.0):
        self.ranks, self.brute = ranks, brute
        self.longest = max(map(len, ranks), default=0)
        rows = [*KEY_ROWS, "abcdefghijklmnopqrstuvwxyz"]
        self.steps = {row[i:i + 2] for r in rows for row in (r, r[::-1]) for i in range(len(row) - 1)}

    def __call__(self, value: str) -> float:
        cost = self.segmented(value)
        if cost > LIST_COST and self.is_text(value):
            rest = re.sub(r"^\w+://", "", value)
            parts = [w for run in re.findall(r"[^\W_]+", rest)
                     for w in ([run] if run.lower() in self.ranks else self.pieces(run))]
            cost = min(cost, LIST_COST + sum(self.segmented(w) for w in parts if w.lower() not in self.ranks and len(w) > 2))
        return cost

    @staticmethod
    def pieces(run: str) -> list[str]:
        """A name of joined words in its words; a run with digits stays whole."""
        return PARTS.findall(run) if run.isalpha() else [run]

    def is_text(self, value: str) -> bool:
        """A path, an address, a call, or three words and more one of which is a function word?"""
        if LISTED.fullmatch(value):
            return True
        words = value.lower().split()
        return len(words) > 2 and any(self.ranks.get(w, math.inf) <= FUNCTION_RANK for w in words)

    def segmented(self, value: str) -> float:
        """The cheapest segmentation."""
        low = value.lower()
        plain = low.translate(LEET) if len(low) == len(value) else low
        n, brute = len(low), self.brute * math.log10(alphabet(value))
        best = [0.0] + [math.inf] * n

        def reach(end: int, cost: float) -> None:
            if cost < best[end]:
                best[end] = cost

        for i in range(n):
            here = best[i]
            reach(i + 1, here + brute)
            for k in range(i + 3, min(n, i + self.longest) + 1):
                if rank := self.ranks.get(low[i:k]):
                    capital = 0 if value[i:k] == low[i:k] else math.log10(2) if value[i:k].istitle() or \
                        value[i:k].isupper() else 1.0
                    reach(k, here + math.log10(rank) + capital)
                elif plain[i:k] != low[i:k] and (rank := self.ranks.get(plain[i:k])):
                    reach(k, here + math.log10(rank) + 1.0)
            if m := DATE.match(low, i):
                reach(m.end(), here + math.log10(365 * 120 if m.end() - i > 6 else 12 * 120 if m.end() - i > 4 else 120))
            if i == 0 or low[i] != low[i - 1]:
                k = i + 1
                while k < n and low[k] == low[i]:
                    k += 1
                if k - i > 2:
                    reach(k, here + math.log10(36 * (k - i)))
            if i == 0 or low[i - 1:i + 1] not in self.steps:
                k = i + 1
                while k < n and low[k - 1:k + 1] in self.steps:
                    k += 1
                if k - i > 2:
                    reach(k, here + math.log10(48 * (k - i)))
        return best[n]


class SecretScanner:
    def __init__(self, vocabulary: str, min_cost: float = MIN_COST):
        self.cost, self.min_cost = GuessCost(word_ranks(vocabulary)), min_cost

    def base(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end) of the fixed patterns, in the order of start, then kind."""
        found, low = [], text.lower()
        if any(w in low for w in ASSIGN_WORDS):
            found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        return sorted(found)

    def guessed(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Values in a credential context that cost many guesses and that no base span touches."""
        low = text.lower()
        if not any(w in low for w in CONTEXT_WORDS):
            return []
        out, at = [], 0
        while m := CONTEXT.search(text, at):
            a, b = m.span(m.lastindex)
            # a bracket that the value opened belongs to it
            while b < len(text) and text[b] in CLOSING and text.count(CLOSING[text[b]], a, b) > text.count(text[b], a, b):
                b += 1
            filled = PLACEHOLDER.match(text, a)
            touching = [e for s, _, e in base if s < b and a < e]
            if touching:
                at = max(a, min(b, max(touching)))
            elif filled and filled.end() >= b:
                at = b
            elif b - a >= MIN_LENGTH and self.cost(text[a:b]) >= self.min_cost:
                out.append((a, 3, b))
                at = b
            else:
                at = a  # a context inside a cheap value has its own value
        return out


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def secret_scan(docs: DataFrame, vocabulary: str, min_cost: float = MIN_COST) -> DataFrame:
    """(doc_id, text, ...) -> (doc_id, n_assign, n_access, n_hex, base_sha256, spans).

    ``spans`` lists kind:start:end (code points, end exclusive) of all base spans and of the values
    ("guess") whose cheapest segmentation costs at least 10^min_cost guesses.  A null text is empty
    and has no spans; null and repeated doc_ids are kept; other columns are not read.
    """
    def scan(batches):
        scanner = SecretScanner(vocabulary, min_cost)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                base = scanner.base(text or "")
                n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                every = sorted(base + scanner.guessed(text or "", base))
                rows.append((*n, hashlib.sha256(spans_text(base).encode()).hexdigest(), spans_text(every)))
            columns = zip(*rows) if rows else [()] * 5
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(list(c), t) for c, t in zip(columns, types)]],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"))
