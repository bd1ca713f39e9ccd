"""N-gram Jaccard join: exact links of similar documents, and their components.

Distances between whole documents do not separate them: nearly all are at
Jaccard distance 1, so a triangle-inequality window around a document pivot
would hold the whole corpus.  The pivots are therefore single shingles, and in
a second place classes of shingles and documents of a region:

* **Voronoi regions.**  The distance of a document of n shingles to the pivot
  {s} is 1 - 1/n if it holds s, else 1; ties go to the pivot that comes first
  in one global order (shingles that are frequent in the corpus come last).
* **Windows.**  A partner within distance 1 - t of x shares a pivot with x
  among the first n - ceil(t n) + 1 of x, so a document is replicated to the
  regions of these pivots and to no others.  Within a region the sizes and the
  positions of the pivot bound the overlap that is still possible.
* **Recursion.**  Each region takes a pivot document, the least by a hash of
  document and region, and measures all its other documents against it.  Linked
  documents form cores, and the region is joined again across cores only: the
  documents outside its largest core meet a pivot of that core, and what is
  still outside meets the others in salted blocks.  Pairs inside a core are
  already decided.  The measured distances to the region's first pivot are
  windows: a pair whose distances to it differ by more than 1 - t is no link.
* **Exact decision.**  The hash classes of all shingles are pivots too: the
  symmetric difference of two sets is at least the number of classes whose
  counts differ in parity.  Pairs beyond this bound are dropped, all others are
  decided on the whole sets.

No step caps a region or a partner list.  Shingles are compared by 64-bit
hashes, sets by 128-bit ones.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import landed, small_batches
from pulsekit.llm.components import connected_components

#: Odd multipliers of the word positions in a shingle's hash.
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                        0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                        0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)
#: Counters of the corpus-wide frequency sketch, and the blocks they travel in.
SKETCH_BITS, BLOCK_BITS = 23, 14
FILTER_BITS = 23
MAX_CACHED_WORDS = 1 << 16
#: Hash classes of the parities that travel with a document into a region's last join.
FOLDED = 512
#: Documents of a region that meet in one join key.
REGION_BLOCK = 512
#: Pivot documents that a region takes one after another before its remaining pairs are formed.
ROUNDS = 2


def _in_small_batches(job):
    """``job(docs, ...)`` runs its Spark jobs with small Arrow batches; what it returns reads landed tables."""
    @wraps(job)
    def run(docs: DataFrame, *args, **kwargs):
        with small_batches(docs.sparkSession):
            return job(docs, *args, **kwargs)

    return run


class Shingler:
    """Sorted distinct shingle hashes of a text; words are cut and lower-cased as bytes."""

    def __init__(self, n: int):
        self.n, self.cache = n, {}

    def all(self, text: str | None) -> np.ndarray:
        found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not found:
            return np.empty(0, np.uint64)
        cache = self.cache
        if len(cache) > MAX_CACHED_WORDS:
            cache.clear()
        for w in set(found).difference(cache):
            cache[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))
        k = min(self.n, len(h))
        m = len(h) - k + 1
        mixed = h ^ (h >> np.uint64(29))
        out = np.full(m, k, np.uint64)
        for i in range(k):
            out += mixed[i:i + m] * MULTIPLIERS[i]
            out ^= out >> np.uint64(31)
        out *= MULTIPLIERS[0]
        out ^= out >> np.uint64(32)
        return out

    def distinct(self, text: str | None) -> np.ndarray:
        return np.unique(self.all(text))


def _texts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        yield batch, batch.column(column).to_pylist()


def _frequent_bits(docs: DataFrame, n: int) -> np.ndarray:
    """One bit per hash slot: does it hold a shingle that many documents share?

    Every shingle of every document is counted, in a sketch of fixed size; a
    slot is frequent beyond the mean load, four times its spread and 16 more.
    Slots only order the pivots, so a shared slot costs time and never a link.
    """
    size, block = 1 << SKETCH_BITS, 1 << BLOCK_BITS

    def count(batches):
        shingler, total = Shingler(n), np.zeros(size, np.uint32)
        for _, texts in _texts(batches, "text"):
            for t in texts:
                np.add.at(total, (shingler.all(t) & np.uint64(size - 1)).astype(np.int64), np.uint32(1))
        for i, r in enumerate(total.reshape(-1, block)):
            if r.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([zlib.compress(r.tobytes(), 1)], pa.binary())],
                                                 ["block", "counts"])

    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, v in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                part = np.frombuffer(zlib.decompress(v), np.uint32)
                sums[k] = sums[k] + part if k in sums else part.astype(np.uint64)
        for k, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()),
                                              pa.array([np.packbits(v > limit).tobytes()], pa.binary()),
                                              ], ["block", "bits"])

    counts = landed(docs.select("text").mapInArrow(count, "block int, counts binary"), "shingle-sketch")
    load = _total(counts) / size
    limit = 16 + load + 4 * load ** 0.5
    bits = counts.repartition("block").mapInArrow(merge, "block int, bits binary")
    out = np.zeros(size // 8, np.uint8)
    for row in bits.toLocalIterator():
        out[row.block * block // 8:(row.block + 1) * block // 8] = np.frombuffer(row.bits, np.uint8)
    return out


def _total(counts: DataFrame) -> int:
    def add(batches):
        yield pa.RecordBatch.from_arrays([pa.array([sum(
            int(np.frombuffer(zlib.decompress(v), np.uint32).sum(dtype=np.uint64))
            for b in batches for v in b.column("counts").to_pylist())], pa.int64())], ["n"])

    return counts.select("counts").mapInArrow(add, "n long").agg(F.sum("n")).first()[0] or 0


def parity_bits(s: np.ndarray) -> bytes:
    """Parities of the counts in 2^k hash classes, at least four classes a shingle."""
    m = 64
    while m < 4 * len(s):
        m *= 2
    g = ((s * MULTIPLIERS[4]) >> np.uint64(20)) & np.uint64(m - 1)
    return np.packbits(np.bincount(g.astype(np.int64), minlength=m) & 1).astype(np.uint8).tobytes()


def folded_parity(s: np.ndarray) -> np.ndarray:
    """The same parities in FOLDED classes, as FOLDED / 64 longs: a bound of fixed size, tested inside a join."""
    g = ((s * MULTIPLIERS[4]) >> np.uint64(20)) & np.uint64(FOLDED - 1)
    return np.packbits(np.bincount(g.astype(np.int64), minlength=FOLDED) & 1).view(np.int64)


def parity_distance(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference of the two sets."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):  # classes m/2 apart fall together in the smaller table
        half = len(x) // 2
        x = x[:half] ^ x[half:]
    return int(np.bitwise_count(x ^ y).sum())


def _described(docs: DataFrame, n: int, num: int, den: int, bits: np.ndarray) -> DataFrame:
    """Per document: set size, set fingerprint, first pivots in the global order, parities."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # 2^SKETCH_BITS bits at every corpus size

    def describe(batches):
        shingler = Shingler(n)
        frequent = np.unpackbits(shared.value).view(bool)
        mask = np.uint64(len(frequent) - 1)
        for batch, texts in _texts(batches, "text"):
            sizes, high, low, pivots, parity, folded = [], [], [], [], [], []
            for text in texts:
                s = shingler.distinct(text)
                k = len(s)
                sizes.append(k)
                if not k:
                    high.append(None), low.append(None), pivots.append(s), parity.append(None), folded.append(None)
                    continue
                f = xxhash.xxh3_128_intdigest(s.tobytes())
                high.append((f >> 64) - (1 << 63))
                low.append((f & ((1 << 64) - 1)) - (1 << 63))
                hot = frequent[(s & mask).astype(np.int64)]
                first = np.concatenate([s[~hot], s[hot]])[:k + (-num * k // den) + 1]
                pivots.append(first)
                parity.append(parity_bits(s))
                folded.append(folded_parity(s))
            ends = np.cumsum([0] + [len(p) for p in pivots]).astype(np.int32)
            flat = np.concatenate(pivots).view(np.int64) if pivots else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int32()), pa.array(high, pa.int64()),
                 pa.array(low, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                 pa.array(parity, pa.binary()), pa.array(folded, pa.list_(pa.int64()))],
                ["doc_id", "n", "f1", "f2", "pivots", "parity", "folded"])

    return landed(docs.mapInArrow(describe, "doc_id long, n int, f1 long, f2 long, "
                                            "pivots array<long>, parity binary, folded array<long>"), "shingle-sets")


def _possible(na: str, pa_: str, nb: str, pb: str, num: int, den: int):
    """Can two sets of these sizes, whose first shared pivot is at these places, be similar enough?"""
    room = F.least(F.col(na) - F.col(pa_), F.col(nb) - F.col(pb))
    return room.cast("long") * (num + den) >= num * (F.col(na).cast("long") + F.col(nb))


def _decided(pairs: DataFrame, docs: DataFrame, described: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    return _measured(pairs, docs, described, n, num, den, False).filter("linked").select("a", "b")


def _measured(pairs: DataFrame, docs: DataFrame, described: DataFrame, n: int, num: int, den: int,
              bounds: bool = True) -> DataFrame:
    """(a, b, lo, hi, linked) for distinct pairs: bounds of their distance, and whether they are similar enough.

    Pairs that the parities rule out have a lower bound only; without ``bounds`` they are left out.
    """
    spark = pairs.sparkSession
    sig = described.filter("n > 0").select("doc_id", "n", "parity")
    both = (pairs.join(sig.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("parity").alias("qa")), "a")
            .join(sig.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("parity").alias("qb")), "b"))

    def near(batches):
        for batch in batches:
            delta = [parity_distance(x, y) for x, y in zip(batch.column("qa").to_pylist(), batch.column("qb").to_pylist())]
            total = [m + k for m, k in zip(batch.column("na").to_pylist(), batch.column("nb").to_pylist())]
            keep = [d * (num + den) <= (den - num) * t for d, t in zip(delta, total)]
            out = pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array([2 * d / (t + d) for d, t in zip(delta, total)], pa.float64()),
                 pa.array(keep, pa.bool_())], ["a", "b", "lo", "keep"])
            yield out if bounds else out.filter(out.column("keep"))

    tested = landed(both.select("a", "b", "na", "nb", "qa", "qb")
                    .mapInArrow(near, "a long, b long, lo double, keep boolean").dropDuplicates(["a", "b"]), "shingle-pairs")
    left = tested.filter("keep").select("a", "b")
    # a Bloom filter of fixed size lets most other texts be skipped before the shuffle
    slot = F.xxhash64("id").bitwiseAND((1 << FILTER_BITS) - 1)
    words = (left.select(F.explode(F.array("a", "b")).alias("id"))
             .select(F.shiftright(slot, 6).alias("w"), F.call_function(
                 "shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int")).alias("x"))
             .groupBy("w").agg(F.bit_or("x").alias("x")))
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for r in words.toLocalIterator():  # at most 2^(FILTER_BITS - 6) rows
        table[r.w] = r.x
    shared = spark.sparkContext.broadcast(table)

    def sets(batches):
        shingler, words_ = Shingler(n), shared.value
        for batch in batches:
            at = np.array(batch.column("slot").to_pylist(), np.int64)
            wanted = (words_[at >> 6] >> (at & 63)) & 1 > 0 if len(at) else np.zeros(0, bool)
            batch = batch.filter(pa.array(wanted, pa.bool_()))
            found = [shingler.distinct(t) for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0] + [len(p) for p in found]).astype(np.int32)
            flat = np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(
                pa.array(ends), pa.array(flat))], ["doc_id", "s"])

    whole = (docs.withColumn("slot", F.xxhash64("doc_id").bitwiseAND((1 << FILTER_BITS) - 1))
             .mapInArrow(sets, "doc_id long, s array<long>"))
    shared_n = F.size(F.array_intersect("sa", "sb")).cast("long")
    exact = (left.join(whole.select(F.col("doc_id").alias("a"), F.col("s").alias("sa")), "a")
             .join(whole.select(F.col("doc_id").alias("b"), F.col("s").alias("sb")), "b")
             .select("a", "b", shared_n.alias("k"), (F.size("sa").cast("long") + F.size("sb") - shared_n).alias("union"))
             .select("a", "b", (1 - F.col("k") / F.col("union")).alias("lo"), (1 - F.col("k") / F.col("union")).alias("hi"),
                     (den * F.col("k") >= num * F.col("union")).alias("linked")))
    # a doc_id may have several texts: near one of them is linked, and no bound holds for all of them
    exact = exact.groupBy("a", "b").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("linked").alias("linked"))
    apart = tested.filter("not keep").select("a", "b", "lo", F.lit(1.0).alias("hi"), F.lit(False).alias("linked"))
    return exact.unionByName(apart) if bounds else exact


def _sizes_allow(n: str, m: str, num: int, den: int):
    return den * F.least(n, m).cast("long") >= num * F.greatest(n, m).cast("long")


def _pair(x: str, y: str) -> list:
    return [F.greatest(x, y).alias("a"), F.least(x, y).alias("b")]


def _live(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of the regions that hold several cores, with their core and the region's largest one."""
    member = (rows.join(roots, "id", "left").withColumn("core", F.coalesce("root", "id")).drop("root"))
    top = (member.groupBy("s", "core").agg(F.count("*").alias("k"))
           .groupBy("s").agg(F.max_by("core", F.struct("k", "core")).alias("top"), F.count("*").alias("cores"))
           .filter("cores > 1").select("s", "top"))
    return member.join(top, "s")


def _pivots(rows: DataFrame, r: int, *columns: str) -> DataFrame:
    """A pivot document for every region: the one with the least hash of (id, region, round)."""
    best = F.min(F.struct(F.xxhash64("id", "s", F.lit(r)), "id", "n", *columns)).alias("x")
    return rows.groupBy("s").agg(best).select("s", F.col("x.id").alias("p"), F.col("x.n").alias("pn"),
                                              *[F.col(f"x.{c}").alias(f"p_{c}") for c in columns])


def _placed(rows: DataFrame, pivots: DataFrame, met: DataFrame, num: int, den: int) -> DataFrame:
    """Rows with bounds lo, hi of the distance to their region's pivot, without the pivot's own.

    Sizes alone bound it for rows that were not measured; these are not joined with the measures."""
    at = rows.join(pivots, "s").filter(F.col("id") != F.col("p"))
    apart = at.filter(~_sizes_allow("n", "pn", num, den)).select(
        "s", "id", "n", "pos", (1 - F.least("n", "pn") / F.greatest("n", "pn")).alias("lo"), F.lit(1.0).alias("hi"))
    near = (at.filter(_sizes_allow("n", "pn", num, den)).select("s", "id", "n", "pos", *_pair("id", "p"))
            .join(met.select("a", "b", "lo", "hi"), ["a", "b"]))
    return near.select("s", "id", "n", "pos", "lo", "hi").unionByName(apart)


@_in_small_batches
def ngram_jaccard_links(docs: DataFrame, n: int = 5, num: int = 75, den: int = 100,
                        rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """-> (described documents, classes of equal sets, links between class representatives).

    The links connect every pair of similar documents, directly or over others;
    pairs inside a core are not listed one by one, ``ngram_jaccard_all_links`` has them.
    """
    docs = docs.select("doc_id", "text").filter("doc_id is not null")
    described = _described(docs, n, num, den, _frequent_bits(docs, n))
    classes = described.filter("n > 0").groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"))
    # one row per class, copies combined before the shuffle; counting and placing read the same exchange
    first = (described.filter("n > 0").groupBy("f1", "f2")
             .agg(F.min(F.struct("doc_id", "n", "pivots")).alias("x")))
    placed = first.select(F.col("x.doc_id").alias("id"), F.col("x.n").alias("n"), F.posexplode("x.pivots").alias("pos", "s"))
    several = placed.groupBy("s").agg(F.count("*").alias("size")).filter("size > 1").select("s")
    rows = landed(placed.join(several, "s").select("s", "id", "n", "pos"), "regions")

    pivots = landed(_pivots(rows, 0), "pivots")
    pairs = (rows.join(pivots, "s").filter((F.col("id") != F.col("p")) & _sizes_allow("n", "pn", num, den))
             .select(*_pair("id", "p")).distinct())
    met = landed(_measured(pairs, docs, described, n, num, den), "met")
    links = met.filter("linked").select("a", "b")
    # a pivot has met all the others and is done in its region; a region of one core stays so
    live = landed(_live(_placed(rows, pivots, met, num, den), connected_components(links)), "region-cores")
    for r in range(1, rounds):
        outer = live.filter(F.col("core") != F.col("top"))
        middle = _pivots(live.filter(F.col("core") == F.col("top")), r, "lo", "hi")
        pairs = (outer.join(middle, "s").filter(_sizes_allow("n", "pn", num, den) & _window("p_", num, den))
                 .select(*_pair("id", "p")).distinct())
        links = landed(links.unionByName(_decided(pairs, docs, described, n, num, den)).distinct(), "links")
        live = landed(_live(live.drop("core", "top"), connected_components(links)), "region-cores")

    # what is left is tested by the folded parities inside the join: only pairs that may be links become rows
    words = [f"q{i}" for i in range(FOLDED // 64)]
    sketch = described.filter("n > 0").groupBy(F.col("doc_id").alias("id"), "n").agg(*[
        F.min(F.get("folded", F.lit(i))).alias(q) for i, q in enumerate(words)], F.count("*").alias("rows"))
    live = live.join(sketch, ["id", "n"])
    differ = sum((F.bit_count(F.col(q).bitwiseXOR(F.col(f"o_{q}"))) for q in words), F.lit(0))
    several = (F.col("rows") > 1) | (F.col("o_rows") > 1)  # a doc_id with several texts of one size has no sketch
    near = several | (differ * (num + den) <= (den - num) * (F.col("n").cast("long") + F.col("o_n")))
    columns = ("id", "n", "pos", "lo", "hi", "core", "rows", *words)
    outer = live.filter(F.col("core") != F.col("top")).select("s", *[F.col(c).alias(f"o_{c}") for c in columns])
    cut = outer.groupBy("s").agg(F.ceil(F.count("*") / REGION_BLOCK).cast("int").alias("blocks"))
    outer = outer.join(cut, "s").withColumn("block", F.pmod(F.xxhash64("o_id"), F.col("blocks")).cast("int")).drop("blocks")
    inner = live.join(cut, "s").select("s", "top", *columns, F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"))
    rest = (outer.join(inner, ["s", "block"])
            .filter((F.col("core") != F.col("o_core"))
                    & ((F.col("core") == F.col("top")) | (F.col("id") < F.col("o_id")))
                    & _possible("n", "pos", "o_n", "o_pos", num, den) & _window("o_", num, den) & near)
            .select(*_pair("id", "o_id")).distinct())
    across = landed(_decided(rest, docs, described, n, num, den), "links")
    return described, classes, links.unionByName(across)


def _window(other: str, num: int, den: int):
    """The triangle inequality leaves room for a link: the distances to the pivot are no further apart than a link."""
    room = F.lit((den - num) / den + 1e-9)
    return (F.col("lo") - F.col(f"{other}hi") <= room) & (F.col(f"{other}lo") - F.col("hi") <= room)


@_in_small_batches
def ngram_jaccard_all_links(docs: DataFrame, n: int = 5, num: int = 75, den: int = 100,
                            block: int = REGION_BLOCK) -> tuple[DataFrame, DataFrame]:
    """-> (every link between classes of equal sets, documents with their number of links).

    Links are (a, b, n_a, n_b): two classes, a > b, and how many documents each holds; every similar pair
    is tested and listed, also inside a component, so a group of G different similar texts gives G squared
    over two rows.  Documents are (doc_id, class, n_shingles, n_class, n_links), one row for each doc_id and
    different set it has; ``n_links`` counts the other ones it is similar to, its own class included.  A class
    is named by the smallest 64-bit text hash in it, and null where the set is empty.  Regions are joined in
    blocks, so that no join key holds more than about twice ``block`` documents.
    """
    text = F.coalesce("text", F.lit(""))
    docs = docs.filter("doc_id is not null").select("doc_id", text.alias("text"), F.xxhash64(text).alias("t"))
    texts = landed(docs.select(F.col("t").alias("doc_id"), "text").dropDuplicates(["doc_id"]), "texts")
    described = _described(texts, n, num, den, _frequent_bits(texts, n))
    classes = described.filter("n > 0").groupBy("f1", "f2").agg(F.min("doc_id").alias("class"))
    placed = landed(described.join(classes, ["f1", "f2"]).filter("doc_id = class")
                    .select(F.col("doc_id").alias("id"), "n", F.posexplode("pivots").alias("pos", "s")), "regions")
    size = placed.groupBy("s").agg(F.count("*").alias("size")).filter("size > 1")
    cut = F.ceil(F.col("size") / block).cast("int")
    region = (placed.join(size.select("s", cut.alias("blocks")), "s")
              .withColumn("h", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
    left = region.select("s", "id", "n", "pos", F.col("h").alias("i"), F.explode(F.expr("sequence(h, blocks - 1)")).alias("j"))
    right = region.select("s", F.col("h").alias("j"), F.explode(F.expr("sequence(0, h)")).alias("i"),
                          *[F.col(c).alias(f"o_{c}") for c in ("id", "n", "pos")])
    pairs = (left.join(right, ["s", "i", "j"])
             .filter(((F.col("i") < F.col("j")) | (F.col("id") < F.col("o_id")))
                     & _possible("n", "pos", "o_n", "o_pos", num, den))
             .select(F.greatest("id", "o_id").alias("a"), F.least("id", "o_id").alias("b")).distinct())
    links = landed(_decided(pairs, texts, described, n, num, den), "all-links")

    of_text = described.join(classes, ["f1", "f2"], "left").select(F.col("doc_id").alias("t"), "class", "n")
    member = landed(docs.select("doc_id", "t").join(of_text, "t")
                    .select("doc_id", "class", F.col("n").cast("long").alias("n_shingles")).distinct(), "class-members")
    sizes = member.filter("class is not null").groupBy("class").agg(F.count("*").alias("n_class"))
    links = (links.join(sizes.select(F.col("class").alias("a"), F.col("n_class").alias("n_a")), "a")
             .join(sizes.select(F.col("class").alias("b"), F.col("n_class").alias("n_b")), "b").select("a", "b", "n_a", "n_b"))
    others = (links.select(F.explode(F.array(F.struct(F.col("a").alias("class"), F.col("n_b").alias("k")),
                                             F.struct(F.col("b").alias("class"), F.col("n_a").alias("k")))).alias("x"))
              .groupBy("x.class").agg(F.sum("x.k").alias("k")))
    documents = (member.join(sizes, "class", "left").join(others, "class", "left")
                 .select("doc_id", "class", "n_shingles", F.coalesce("n_class", F.lit(0)).alias("n_class"),
                         (F.coalesce(F.col("n_class") - 1, F.lit(0)) + F.coalesce("k", F.lit(0))).alias("n_links")))
    return links, documents


def ngram_jaccard_components(docs: DataFrame, n: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """(doc_id, text, ...) -> (doc_id, n_shingles, component_id), one row per input row.

    ``component_id`` is the smallest doc_id that links reach, the document's own
    included; two documents link if ``den * shared >= num * union`` over their
    distinct n-word shingles.  Words are runs of other characters than space and
    U+0009 to U+000D, with A-Z in lower case; a text of fewer words is one
    shingle.  A null or wordless text has an empty set and links with nothing.
    A doc_id that several rows have is one node with all their links.  A row
    without doc_id gets its set size 0 and a null component.  Other columns are
    not read.  An empty table gives an empty result.
    """
    described, classes, links = ngram_jaccard_links(docs, n, num, den)
    # rows of one class and one doc_id are joined too
    merge = (described.filter("n > 0").join(classes, ["f1", "f2"]).select("doc_id", "rep").distinct())
    merge = merge.filter(F.col("doc_id") != F.col("rep"))
    repeated = described.groupBy("doc_id").agg(F.count("*").alias("k")).filter("k > 1").select("doc_id")
    links = links.unionByName(merge.join(repeated, "doc_id", "left_semi")
                              .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    core = connected_components(links)
    out = (described.select("doc_id", "n", "f1", "f2").join(classes, ["f1", "f2"], "left")
           .join(core.select(F.col("id").alias("rep"), "root"), "rep", "left"))
    own = core.select(F.col("id").alias("doc_id"), F.col("root").alias("own"))
    out = (out.join(own, "doc_id", "left")
           .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                   F.coalesce("root", "own", F.least("rep", "doc_id"), "doc_id").alias("component_id")))
    missing = docs.filter("doc_id is null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_shingles"),
        F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(missing)
