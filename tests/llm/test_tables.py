"""Pages, URLs, dialogues, vectors, oracles and the pipeline."""

import html
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as C
from pulsekit.llm.chat import perspective_rotation
from pulsekit.llm.hnsw import Graph, nearest_neighbours
from pulsekit.llm.html_extract import extract_main_text, main_lines
from pulsekit.llm.oracle import oracle_sql
from pulsekit.llm.url_filter import fold, split_url, url_filter, url_scores, with_rule
from tests.conftest import SF001, SF01
from tests.llm.test_pairs import brute
from tests.llm.test_texts import expected_counts, expected_spans
from tests.oracle_compare import compare, connect


# --- pages

def test_pages_give_their_article(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    got = {r.page_id: r for r in extract_main_text(pages).collect()}
    for p in pages.collect():
        article = p.html[p.html.index("<article>") + 9:p.html.index("</article>")]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", b))).strip()
                  for b in re.split(r"</?p>|<br>|</?h1>", article)]
        want = "\n".join(b for b in blocks if b)
        assert (got[p.page_id].text, got[p.page_id].n_chars, got[p.page_id].url) == (want, len(want), p.url)


LONG = "Some words of running text that go on for quite a while, as they do in an article. " * 3


@pytest.mark.parametrize("page, want", [
    (None, []), ("", []), ("<p></p>", []), ("plain text", ["plain text"]),
    (f"<body><div class='menu'><a href=x>Home</a></div><div id=content><h1>T</h1><p>{LONG}</p><p>Short.</p></div>"
     f"<div class='sidebar'><p>{LONG}</p></div><section id=comments><p>{LONG}</p></section></body>",
     ["T", LONG.strip(), "Short."]),
    (f"<main><article><p>a&amp;b &eacute; &#8212;{LONG}<p>x <b>bold</b>\n\t y<form><p>Name</form><aside>{LONG}</aside>"
     "<div class='cookie-notice'>We use cookies</div></article></main>",
     [f"a&b é —{LONG}".strip(), "x bold y"]),
    (f"<article><header><p>By me</p></header><p>{LONG}</p><script>var a='</p>'+'{LONG}'</script><table><tr><td>1<td>2</table>",
     [LONG.strip(), "1", "2"]),
])
def test_made_up_pages(page, want):
    assert main_lines(page) == want


PARAS = [f"{i} {LONG}".strip() for i in range(10)]


@pytest.mark.parametrize("page, want", [
    (f"<article><h1>Title</h1><div class='content'><p>{LONG}<p>{LONG}</div><p>closing</p></article>",
     ["Title", LONG.strip(), LONG.strip(), "closing"]),
    (f"<body><div><p>{'<p>'.join(PARAS[:9])}</div><div><p>{PARAS[9]}</div></body>", PARAS),
    (f"<body><div>{PARAS[0]}</div><div>Short.</div><div>{PARAS[1]}</div></body>",
     [PARAS[0], "Short.", PARAS[1]]),
    *[(f"<body><nav>Home</nav><div class='{name}'><h1>T</h1><p>{'<p>'.join(PARAS)}<p>Short.</p><div class='sidebar'><p>{LONG}</p></div>"
       f"</div><div class='legal'>{LONG}</div></body>", ["T", *PARAS, "Short."])
      for name in ("page-with-sidebar", "content comments-open", "post legal")],
    (f"<body><div class='post'><h1>T</h1><div class='text'><p>{LONG}<span class='advert'>Buy</span></div><p>closing</div></body>",
     ["T", LONG.strip(), "closing"]),
])
def test_pages_lose_nothing_of_the_article(page, want):
    assert main_lines(page) == want


def test_no_pages(spark):
    rows = spark.createDataFrame([(None, None, None, 1), (1, "u", "<p>a", 1), (1, "u", "<p>a", 1)],
                                 "page_id long, url string, html string, text int")
    assert sorted(map(tuple, extract_main_text(rows).collect()), key=str) == sorted(
        [(None, None, "", 0), (1, "u", "a", 1), (1, "u", "a", 1)], key=str)
    assert extract_main_text(rows.limit(0)).collect() == []


# --- URLs

URLS = ["http://A.Org/x?y", "https://example.org/en/12#z", "http://m.example.org/es/", "http://notexample.org/es/1",
        "http://a.com/fr/1", "http://a.com/de/1", "http://a.com/De/1", "http://x.org", "no url", None, "",
        "http://x.org?q=/", "a://b://c/d", "http://org/", "://"]


def test_url_rules(spark):
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)], "page_id long, url string, html string")
    rows = with_rule(df.select("page_id", "url")).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.ruled) for r in rows] == [
        ("a.org", "/x", "org/", "allow"), ("example.org", "/en/12", "example.org/en/1", "block"),
        ("m.example.org", "/es/", "example.org/es/", "block"), ("notexample.org", "/es/1", "org/", "allow"),
        ("a.com", "/fr/1", "com/fr/", "allow"), ("a.com", "/de/1", "com/de/", "block"), ("a.com", "/De/1", None, None),
        ("x.org", "", None, None), ("", "", None, None), ("", "", None, None), ("", "", None, None),
        ("x.org", "", None, None), ("b:", "//c/d", None, None), ("org", "/", "org/", "allow"), ("", "", None, None)]
    assert all(r.verdict in ("allow", "block") for r in url_filter(df).collect())
    assert url_filter(df.limit(0)).collect() == []


def test_url_scores_separate_held_out_urls(spark):
    pages = with_rule(spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url")).withColumn("key", F.concat("host", "path"))
    urls = pages.groupBy("key").agg(F.count(F.when(F.col("ruled") == "allow", 1)).alias("yes"),
                                    F.count(F.when(F.col("ruled") == "block", 1)).alias("no"))
    held = url_scores(urls).filter((fold(F.col("key")) == 0) & (F.col("yes") + F.col("no") > 0)).collect()
    pairs = [(a.score > b.score) + 0.5 * (a.score == b.score) for a in held for b in held if a.yes and b.no]
    assert len(pairs) > 1000 and sum(pairs) / len(pairs) > 0.75  # area under the curve


def test_url_scores_against_plain_python(spark):
    data = [("aab", 3, 0), ("abb", 0, 2), ("aabb", 1, 1), ("", 0, 0), ("zz", 0, 0), ("abab", 2, 0), ("bbbb", 0, 5)]
    df = spark.createDataFrame(data, "key string, yes long, no long")
    folds = {r["key"]: r["f"] for r in df.select("key", fold(F.col("key")).alias("f")).collect()}

    def events(k):
        p = "\2" * 3 + k + "\3"
        return [(p[i:i + 3], p[i + 3]) for i in range(len(k) + 1)]

    def prob(which, context, ch):
        p = 1 / 256
        for k in range(4):
            c = context[3 - k:]
            counts = {}
            for key, *w in data:
                if folds[key] and sum(w) and w[which]:
                    for ctx, x in events(key):
                        if ctx[3 - k:] == c:
                            counts[x] = counts.get(x, 0) + w[which]
            n, t = sum(counts.values()), len(counts)
            p = (counts.get(ch, 0) + t * p) / (n + t) if n + t else p
        return p

    for r in url_scores(df).collect():
        want = np.mean([np.log(prob(0, *e)) - np.log(prob(1, *e)) for e in events(r["key"])])
        assert abs(r["score"] - want) < 1e-9


# --- dialogues

def test_dialogues(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 2, "bob", "hi"), (1, 1, "ann", "hello\n"), (1, 1, "ann", "hello\n"),
            (1, None, None, None), (2, 700, "ann", "é"), (2, 3, "bob", ""), (None, 1, "ann", "lost"), (3, 1, "system", "alone")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, start string")
    out = perspective_rotation(df).collect()
    assert {(r.conv_id, r.perspective) for r in out} == {(1, "ann"), (1, "bob"), (1, "unknown"), (2, "ann"), (2, "bob")}
    for c, who in {(r.conv_id, r.perspective) for r in out}:
        mine = sorted((r for r in out if (r.conv_id, r.perspective) == (c, who)), key=lambda r: r.start)
        whole = "".join(r.segment for r in mine)
        assert len(mine) == sum(x[0] == c for x in rows)
        for r in mine:
            assert whole[r.start:r.end] == r.segment and r.mask == (r.name == who)
            if r.mask:
                assert whole[r.mask_start:r.mask_end].endswith("<|im_end|>") and r.segment.startswith("<|im_start|>assistant\n")
            else:
                assert r.mask_start is None and (r.role == "system" or f"user name={r.name}\n" in r.segment)
    assert perspective_rotation(df.limit(0)).collect() == []


# --- vectors

def exact(rows, every, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v
          and np.isfinite(v).all() and np.any(v) and len(v) == 8]
    out = {}
    for q, x in ok:
        if q % every == 0:
            near = sorted((-float(y @ x), i) for i, y in ok if i != q)[:k]
            out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(near)]
    return out


def test_vectors_with_copies_and_gaps(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).round(3).tolist()) for i in range(300)]
    rows += [(1000 + i, [1.0] * 8) for i in range(200)] + [(400, None), (420, [0.0] * 8), (440, [1.0, None] + [0.0] * 6),
             (460, [float("nan")] * 8), (480, [float("inf")] + [0.0] * 7), (500, [1.0]), (None, [1.0] * 8)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = {}
    for r in nearest_neighbours(df, shard=128).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = exact(rows, 20, 20)
    assert set(got) == set(want)
    hits = 0
    for q, near in want.items():
        mine = sorted(got[q])
        assert [r for r, *_ in mine] == list(range(1, 21)) and q not in [i for _, i, _ in mine]
        assert mine == sorted(mine, key=lambda x: (-x[2], x[1]))
        hits += len({i for _, i, _ in mine} & {i for _, i, _ in near})
    assert hits >= 0.95 * 20 * len(want)
    assert nearest_neighbours(df.limit(0)).collect() == []


def test_recall_on_the_table(spark):
    table = spark.read.parquet(f"{SF01}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    x, ids = np.array([v for _, v in rows], float), np.array([i for i, _ in rows])
    g = Graph.build(x)
    hits = [len(set(ids[g.nearest(x[i], 21)]) & set(ids[np.argsort(-(x @ x[i]), kind="stable")[:21]])) for i in range(0, len(x), 20)]
    assert np.mean(hits) >= 0.9 * 21


# --- oracles and the pipeline

@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_oracle(spark, name):
    df = E.queries()[name](spark, SF001)
    rows, con = df.collect(), connect(SF001)
    res = con.execute(E.oracle_sql()[name])
    columns, same_n, same_values, a, b = compare(df.columns, rows, [d[0] for d in res.description], res.fetchall())
    assert rows and columns and same_n and same_values, (list(a.items())[:2], list(b.items())[:2])


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(C.STAGES)
    kept = stages["quality_rules"](spark, docs, SF001)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    kept = kept.cache()
    rows = kept.collect()
    assert rows and all(not expected_counts(texts[r.doc_id])[5] and r.n_chars == len(r.text) for r in rows)
    one = stages["ngram_jaccard"](spark, kept, SF001).cache()
    roots = {c for _, _, c in brute([(r.doc_id, r.text) for r in rows])}
    assert sorted(r.doc_id for r in one.collect()) == sorted(roots) and one.columns == docs.columns
    masked = stages["personal_data"](spark, one, SF001).collect()
    assert len(masked) == len(roots) and not any(expected_spans(r.text) for r in masked)
    packed = C.run(spark, SF001).collect()
    assert {r.doc_id for r in packed} == roots


def test_texts_that_share_a_doc_id_stay(spark):
    one, two = ["".join(f"{w}{i} " for i in range(60)) for w in ("a", "b")]
    rows = [(1, one), (1, two), (1, one), (2, one + "end"), (3, two.upper()), (4, "x y"), (None, "x y"), (5, None), (5, "")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    out = dict(C.STAGES)["ngram_jaccard"](spark, df, SF001)
    assert out.columns == df.columns
    assert sorted([(r.doc_id, r.text) for r in out.collect()], key=str) == sorted(
        [(1, one), (1, two), (4, "x y"), (None, "x y"), (5, None), (5, "")], key=str)


def test_pipeline_on_nothing(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, SF001)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count() == 0
    assert C.STAGES[-1][1](spark, docs, SF001).count() == 0
