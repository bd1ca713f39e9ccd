"""URL rules and a character language-model ratio, in DataFrame functions only.

Two Markov models of variable order, one of accepted and one of rejected URLs,
are counts of (context, next character) for contexts of three characters and all
their shorter suffixes, smoothed after Witten and Bell: each order hands the
weight of its new events to the next shorter one.  A URL is accepted if the
log-likelihood difference per character reaches a threshold that is calibrated
on labelled URLs kept out of the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import ascii_lower, landed

#: Rules (verdict, host, path).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
ORDER = 3
#: Characters of the lowest model, which all get the same weight.
ALPHABET = 256
#: One in so many labelled URLs calibrates the threshold.
FOLDS = 5
BINS = 100
START, END = "\u0002", "\u0003"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    return (ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1)),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def with_rule(pages: DataFrame, rules=RULES) -> DataFrame:
    """Adds host, path, rule and ruled: the longest rule that fits, and its verdict."""
    host, path = split_url(F.col("url"))
    out = pages.withColumn("host", host).withColumn("path", path)
    fits = [((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p) for _, h, p in rules]
    best = sorted(zip(rules, fits), key=lambda x: -len(x[0][1] + x[0][2]))
    return out.withColumns({
        "rule": F.coalesce(*[F.when(f, F.lit(h + p)) for (_, h, p), f in best]),
        "ruled": F.coalesce(*[F.when(f, F.lit(v)) for (v, _, _), f in best])})


def fold(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key), 1, 4), 16, 10).cast("int") % FOLDS


def _events(urls: DataFrame, *keep: str) -> DataFrame:
    """One row per character and end: context of ORDER characters, and the character."""
    padded = F.concat(F.lit(START * ORDER), F.col("key"), F.lit(END))
    i = F.explode(F.sequence(F.lit(1), F.length("key") + 1)).alias("i")
    return (urls.select(*keep, padded.alias("padded"), i)
            .select(*keep, F.expr(f"substring(padded, i, {ORDER})").alias("context"),
                    F.expr(f"substring(padded, i + {ORDER}, 1)").alias("next")))


def _suffix(column: str, length: int) -> Column:
    return F.expr(f"right({column}, {length})") if length else F.lit("")


def log_ratios(events: DataFrame, wanted: DataFrame) -> DataFrame:
    """(context, next, ratio): log of P(next | context) if accepted over the same if rejected.

    ``events`` has (context, next, yes, no) counts, ``wanted`` the distinct pairs to rate.
    """
    rated = wanted
    p = {"yes": F.lit(1.0 / ALPHABET), "no": F.lit(1.0 / ALPHABET)}
    for k in range(ORDER + 1):
        # the counts of the shorter contexts come from the aggregated counts, not from the texts again
        c = (events.groupBy(_suffix("context", k).alias(f"c{k}"), F.col("next"))
             .agg(F.sum("yes").alias(f"yes{k}"), F.sum("no").alias(f"no{k}")))
        t = c.groupBy(f"c{k}").agg(*[f(x) for x in ("yes", "no") for f in (
            lambda x: F.sum(f"{x}{k}").alias(f"n_{x}{k}"),
            lambda x: F.count(F.when(F.col(f"{x}{k}") > 0, 1)).alias(f"t_{x}{k}"))])
        rated = (rated.withColumn(f"c{k}", _suffix("context", k))
                 .join(c, [f"c{k}", "next"], "left").join(t, f"c{k}", "left"))
        for x in ("yes", "no"):
            n, kinds, own = (F.coalesce(F.col(f"{a}{x}{k}"), F.lit(0)).cast("double") for a in ("n_", "t_", ""))
            p[x] = F.when(n + kinds > 0, (own + kinds * p[x]) / (n + kinds)).otherwise(p[x])
    return rated.select("context", "next", (F.log(p["yes"]) - F.log(p["no"])).alias("ratio"))


def url_scores(urls: DataFrame) -> DataFrame:
    """(key, yes, no) -> (key, yes, no, score), one row per key.

    ``yes`` and ``no`` count accepted and rejected pages of the key; keys of fold 0 are not counted.
    """
    urls = landed(urls, "urls")
    train = urls.filter((fold(F.col("key")) != 0) & (F.col("yes") + F.col("no") > 0))
    counts = landed(_events(train, "yes", "no").groupBy("context", "next")
                    .agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")), "url-counts")
    events = _events(urls, "key")
    ratios = landed(log_ratios(counts, events.select("context", "next").distinct()), "url-ratios")
    scored = events.join(ratios, ["context", "next"]).groupBy("key").agg(F.avg("ratio").alias("score"))
    return urls.join(scored, "key")


def threshold(scored: DataFrame) -> float:
    """The bin edge with the best balanced accuracy on the labelled keys of fold 0, next to 0 if several are.

    Scores are differences of mean log-likelihoods, so there are some hundred bins at every size.
    """
    b = F.greatest(F.least(F.floor(F.col("score") * BINS), F.lit(20 * BINS)), F.lit(-20 * BINS)).cast("int")
    bins = (scored.filter((fold(F.col("key")) == 0) & (F.col("yes") + F.col("no") > 0))
            .groupBy(b.alias("bin")).agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).collect())
    yes, no = sum(r["yes"] for r in bins), sum(r["no"] for r in bins)
    if not yes or not no:
        return 0.0

    def quality(edge: int) -> float:
        return (sum(r["yes"] for r in bins if r["bin"] >= edge) / yes
                + sum(r["no"] for r in bins if r["bin"] < edge) / no)

    edges = {0} | {r["bin"] for r in bins} | {r["bin"] + 1 for r in bins}
    return min(edges, key=lambda e: (-quality(e), abs(e), e)) / BINS


def url_filter(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, url, ...) -> (page_id, host, path, rule, verdict, score), one row per page.

    The longest rule that fits a page decides; all other pages get the models' verdict from host and
    path.  Equal host and path are rated once and weigh by their pages.  A null url has empty host
    and path and is rated as such; null and repeated page ids are kept; other columns are not read.
    Without labelled pages of both verdicts the threshold is 0.  An empty table gives an empty result.
    """
    ruled = with_rule(pages.select(F.col("page_id").cast("long").alias("page_id"), "url"), rules)
    ruled = ruled.withColumn("key", ascii_lower(F.concat("host", "path")))
    urls = ruled.groupBy("key").agg(F.count(F.when(F.col("ruled") == "allow", 1)).alias("yes"),
                                    F.count(F.when(F.col("ruled") == "block", 1)).alias("no"))
    scored = landed(url_scores(urls), "url-scores")
    cut = threshold(scored)
    return (ruled.join(scored.select("key", "score"), "key")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("ruled", F.when(F.col("score") >= cut, F.lit("allow")).otherwise(F.lit("block")))
                    .alias("verdict"), "score"))
