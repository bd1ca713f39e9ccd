"""Filter interaction audit by forward-backward path counting over the subset lattice.

A state is the set of filters already applied; an edge applies one more.  A document is the set of
filters it fails, so a part of the corpus is a histogram over these sets, and an edge's counts are sums over
it.  ``forward`` counts the orders that reach a state and ``backward`` those that leave it for the full set:
their product is the number of orders through an edge, which weights its removals for the Shapley sums.  The
steps of every order are read from the same edges, never counted again.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.llm.common import count_chars, landed, let, words

FILTERS = "ABCDE"
#: The lattice has n * 2^(n-1) edges and n! orders; they are driver-side constants, so n is bounded.
MAX_FILTERS, MAX_ORDERED = 12, 7
#: Contract bounds: words, share of distinct words, share of capitals, symbols.
MIN_WORDS, DISTINCT_SHARE, CAPITAL_SHARE, SYMBOLS = 200, 50, 3, r"[#$%&*|]"


def path_counts(n: int) -> tuple[list[int], list[int]]:
    """(forward, backward): orders that reach each state from none applied, and from it all applied."""
    size = 1 << n
    forward, backward = [0] * size, [0] * size
    forward[0] = backward[size - 1] = 1
    for state in range(size):
        for f in range(n):
            if not state >> f & 1:
                forward[state | 1 << f] += forward[state]
    for state in reversed(range(size)):
        for f in range(n):
            if not state >> f & 1:
                backward[state] += backward[state | 1 << f]
    return forward, backward


def text_failures(text: Column) -> Column:
    """Bits 0 to 3: the text fails A, B, C, D.  Null text is empty."""
    text = F.coalesce(text, F.lit(""))

    def bits(w: Column) -> Column:
        n = F.size(w)
        return (F.when(n < MIN_WORDS, 1).otherwise(0)
                + F.when(100 * F.size(F.array_distinct(w)) < DISTINCT_SHARE * n, 2).otherwise(0))

    capitals = F.when(100 * count_chars(text, "A-Z") > CAPITAL_SHARE * F.length(text), 4).otherwise(0)
    return (let(words(text), bits) + capitals + F.when(text.rlike(SYMBOLS), 8).otherwise(0)).cast("int")


def failure_sets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """-> (part, fails, good, toxic, n): documents by part, failed filters (bits of ABCDE) and label.

    E fails when a smaller doc_id has the same text anywhere in the table; texts are compared by SHA-256.
    Equal (doc_id, text, part) rows are counted, not repeated, and the first doc_id of a text is joined on
    (text, doc_id): no key of either join holds more than the different texts and parts of one doc_id, however
    many copies a text has.  A null doc_id is neither smaller nor larger than another and has no label.  Labels
    with several rows for a doc_id count if any of them is 1.
    """
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    rows = landed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
                              F.unhex(digest).alias("digest"), text_failures(F.col("text")).alias("fails")), "failures")
    known, unnamed = rows.filter("doc_id is not null"), rows.filter("doc_id is null")
    first = (known.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
             .select("digest", "doc_id", F.lit(0).alias("again")))
    counted = known.groupBy("digest", "doc_id", "part", "fails").agg(F.count("*").alias("n"))
    marked = (counted.join(first, ["digest", "doc_id"], "left")
              .select("doc_id", "part", "n", (F.col("fails") + F.coalesce("again", F.lit(16))).alias("fails")))
    one = (labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
           .agg(F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
                F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic")))
    labelled = (marked.groupBy("doc_id", "part", "fails").agg(F.sum("n").alias("n")).join(one, "doc_id", "left")
                .select("part", "fails", F.coalesce("good", F.lit(0)).alias("good"),
                        F.coalesce("toxic", F.lit(0)).alias("toxic"), "n"))
    rest = unnamed.select("part", "fails", F.lit(0).alias("good"), F.lit(0).alias("toxic"), F.lit(1).cast("long").alias("n"))
    return (labelled.unionByName(rest).groupBy("part", "fails", "good", "toxic").agg(F.sum("n").alias("n")))


def lattice_edges(failures: DataFrame, names: str = FILTERS) -> DataFrame:
    """(part, fails, good, toxic, n) -> a row per part and edge (state, filter): kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, orders (through the edge) and shapley (the filter's sum).

    ``state`` has the bits of the filters applied before.  ``names`` has one letter a filter, bit 0 first.
    """
    n = len(names)
    if not 0 < n <= MAX_FILTERS:
        raise ValueError(f"{n} filters, of 1 to {MAX_FILTERS}")
    forward, backward = path_counts(n)
    edges = [(s, f) for s in range(1 << n) for f in range(n) if not s >> f & 1]
    constant = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("bit"),
                                  F.lit(forward[s] * backward[s | 1 << f]).cast("long").alias("orders"))
                         for s, f in edges])
    # at most 2^n * 4 rows a part meet the constant edges
    e = failures.select("part", "fails", "good", "toxic", "n", F.explode(constant).alias("e")).select("*", "e.*").drop("e")
    one = F.expr("shiftleft(1, bit)")
    fails = F.col("fails").bitwiseAND(one) != 0
    before = F.col("fails").bitwiseAND(F.col("state")) != 0
    removed = ~before & fails

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    counted = e.groupBy("part", "state", "bit", "orders").agg(
        total(~before & ~fails).alias("kept"), total(removed).alias("removed"), total(before & fails).alias("redundant"),
        total(F.col("fails") == one).alias("unique_fails"), total(removed & (F.col("good") == 1)).alias("good_lost"),
        total(removed & (F.col("toxic") == 1)).alias("toxic_lost"))
    of_filter = Window.partitionBy("part", "bit")  # 2^(n-1) edges
    return (counted.withColumn("shapley", F.sum(F.col("removed") * F.col("orders")).over(of_filter))
            .withColumn("filter", F.substring(F.lit(names), F.col("bit") + 1, F.lit(1))))


def order_steps(edges: DataFrame, names: str = FILTERS) -> DataFrame:
    """The edges along every order: (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley)."""
    n = len(names)
    if n > MAX_ORDERED:
        raise ValueError(f"the orders of {n} filters, of {MAX_ORDERED} at most")
    steps = []
    for order in permutations(range(n)):
        state = 0
        for step, f in enumerate(order, 1):
            steps.append(("".join(names[x] for x in order), step, state, f))
            state |= 1 << f
    walked = edges.sparkSession.createDataFrame(steps, "filter_order string, step int, state int, bit int")
    return edges.join(F.broadcast(walked), ["state", "bit"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, lang, ...), (doc_id, quality, toxic, ...) -> a row per part, order of ABCDE and step.

    A null or empty text has no words; a null lang is the empty part; documents without a label are neither
    good nor toxic; repeated rows count each; an empty table gives an empty result; other columns are not read.
    """
    return order_steps(lattice_edges(landed(failure_sets(docs, labels), "failure-sets")))
