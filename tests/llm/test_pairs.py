"""Jaccard links against brute force; edge cases."""

import os
import random
import uuid
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from pulsekit.llm.components import connected_components
from pulsekit.llm.ngram_jaccard import (ngram_jaccard_all_links, ngram_jaccard_components, ngram_jaccard_links,
                                         parity_bits, parity_distance, Shingler)
from tests.conftest import SF001

SCHEMA = "doc_id long, text string, n int, core long, s string"


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, x), (b, y) in combinations(sets, 2):
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return sorted((i, len(s), find(i)) for i, s in sets)


def run(spark, rows):
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], SCHEMA)
    return [tuple(r) for r in ngram_jaccard_components(df).collect()]


def test_edited_copies_and_edge_cases(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(6):
        base = [rng.choice(vocab) for _ in range(rng.choice([4, 12, 60, 90]))]
        for _ in range(12):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((n, " ".join(w)))
            n += 1
    passage = " ".join(rng.choice(vocab) for _ in range(55))
    for _ in range(25):  # one long passage that many documents share
        rows.append((n, passage + " " + " ".join(rng.choice(vocab) for _ in range(rng.randrange(30)))))
        n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, "one"), (n + 4, "ONE"), (n + 5, "É one"), (n + 6, "é one"),
             (n + 7, "a b"), (n + 8, "a b"), (n + 9, " ".join(f"x{i}" for i in range(30000)))]
    assert sorted(run(spark, rows)) == brute(rows)


def test_repeated_rows_and_missing_ids(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(5, text), (5, text), (7, text), (5, "other words here"), (9, "other words here"), (None, text), (None, None)]
    got = sorted(run(spark, rows), key=str)
    # rows that share a doc_id are one node: 9 is linked with 5 over its second row, 7 over its first
    assert got == sorted([(5, 16, 5), (5, 16, 5), (7, 16, 5), (5, 1, 5), (9, 1, 5), (None, 0, None), (None, 0, None)], key=str)


@pytest.mark.parametrize("block", [512, 3])
def test_every_link_is_listed(spark, block):
    rng = random.Random(8)
    base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
    texts = [" ".join(base[:i] + [f"edit{i}"] + base[i + 1:]) for i in range(0, 100, 5)]  # similar, all different
    texts += [texts[0], texts[0].upper(), " ".join(base[:70]), "other words", None, "", "Other words"]
    rows = list(enumerate(texts)) + [(0, texts[0]), (0, "other words"), (None, texts[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    links, documents = ngram_jaccard_all_links(df, block=block)
    nodes = {(i, frozenset(shingles(t))) for i, t in rows if i is not None}
    near = {(x, y) for x, y in combinations(sorted({s for _, s in nodes if s}, key=sorted), 2)
            if 100 * len(x & y) >= 75 * len(x | y)}
    size = {s: sum(s == t for _, t in nodes) for _, s in nodes}
    got = links.collect()
    assert len(got) == len(near) > 150 and all(r.a > r.b for r in got)
    assert sorted(sorted((r.n_a, r.n_b)) for r in got) == sorted(sorted((size[x], size[y])) for x, y in near)
    want = sorted((i, len(s), size[s] if s else 0, sum(t != u and (s == u[1] or (s, u[1]) in near or (u[1], s) in near)
                                                     for u in nodes) if s else 0) for t in nodes for i, s in [t])
    assert sorted((r.doc_id, r.n_shingles, r.n_class, r.n_links) for r in documents.collect()) == want


def test_empty_table(spark):
    assert run(spark, []) == []


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in ngram_jaccard_components(docs).collect()) == brute(rows)


def test_texts_reach_python_in_small_batches(spark, tmp_dir):
    rng = random.Random(5)
    vocab = [f"word{i}" for i in range(3000)]
    rows = [(i, " ".join(rng.choices(vocab, k=2000)), 1, 2, "x") for i in range(400)]

    def seen(batches):  # a file for every batch that a worker gets, named by its size
        for batch in batches:
            open(f"{tmp_dir}/{batch.nbytes}-{uuid.uuid4().hex}", "w").close()
            yield batch

    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1).mapInArrow(seen, SCHEMA)
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit, None)
    got = ngram_jaccard_links(docs)[0].count()
    sizes = [int(f.split("-")[0]) for f in os.listdir(tmp_dir)]
    assert got == 400 and sum(sizes) > 5_000_000 and max(sizes) < 1_500_000
    assert spark.conf.get(limit, None) == before


def test_parity_distance_bounds_the_difference():
    rng, sh = random.Random(1), Shingler(1)
    for _ in range(200):
        a = sh.distinct(" ".join(str(rng.randrange(300)) for _ in range(rng.randrange(1, 400))))
        b = sh.distinct(" ".join(str(rng.randrange(300)) for _ in range(rng.randrange(1, 40))))
        assert parity_distance(parity_bits(a), parity_bits(b)) <= len(set(a.tolist()) ^ set(b.tolist()))


@pytest.mark.parametrize("links", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)],
                                   [(3, 3), (2, 1), (1, 2), (9, 4), (4, 7), (7, 9), (None, 1)]])
def test_components(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    got = {(r.id, r.root) for r in connected_components(df).collect()}
    root = {x: x for p in links if None not in p for x in p}
    for _ in root:
        for a, b in links:
            if a is not None and b is not None:
                root[a] = root[b] = min(root[a], root[b])
    assert {x for x, _ in got} <= set(root) and all(root[x] == r for x, r in got)
    assert all(x in dict(got) for x, r in root.items() if x != r)
