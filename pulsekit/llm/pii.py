"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts.

All in DataFrame functions.  The spans of the fixed patterns are seeds.  The word
before and the word after an identifier are its lexical patterns; a graph joins
patterns with the identifiers they stand at.  Patterns are scored by the share
of their identifiers that are known, identifiers by the patterns that hold them,
in turns; words that only highly scored patterns point to, and that look like
the kind, are new identifiers.  Numbers written with blanks are one such word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.llm.common import landed, let

#: Fixed: kinds in the order of the result, and their patterns.  Possessive forms of
#: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ and so on: same matches, no backtracking.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Words with a digit or an at sign: what else may be an identifier.
CANDIDATE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
#: Digits with blanks, brackets, dots and hyphens between them: a number written in groups.
RUN = r"[(\[]{0,2}+[0-9]++(?:[\x20()\[\].-]++[0-9]++)++"
#: Kinds of candidates, after KINDS: a word, and a number written with blanks.
WORD_OF, RUN_OF = len(KINDS), len(KINDS) + 1
#: Code points of a block of text from which masking cuts.
BLOCK = 1024
ROUNDS, MIN_CONFIDENCE, MIN_SEEDS = 3, 0.9, 5


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(x: Column) -> Column:
    """Does the digit string pass the Luhn test?"""
    def value(i: Column) -> Column:
        d = F.ascii(F.substr(F.reverse(x), i, F.lit(1))) - 48
        return F.when(i % 2 == 1, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.length(x)), value), F.lit(0), lambda a, v: a + v)
    return total % 10 == 0


def _holds(kind: str, x: Column) -> Column:
    """The test that a match of the pattern has to pass."""
    if kind == "ip":
        part = F.split(x, r"\.")
        return F.forall(part, lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
                        & (F.right(p, F.lit(3)).cast("int") <= 255))
    if kind == "card":
        d = F.translate(x, " -", "")
        return F.length(d).between(13, 19) & let(d, _luhn)
    if kind == "phone":
        return F.length(_digits(x)).between(9, 15)
    return F.lit(True)


def running(items: Column, zero: Column, step, empty: str, levels: int = 2) -> Column:
    """``[y1, y2, ...]`` of a fold that gives out a value an item: ``step(state, item) -> struct(state, y)``.

    A fold that appends to one array copies it for every item.  Here parts of n^(2/3) items, and parts of
    n^(1/3) in them, fold for themselves, so n items cost n^(4/3) pointer copies.  ``empty`` is the
    type of the result.
    """
    none = F.array().cast(empty)

    def one(acc: Column, item: Column) -> Column:
        return let(step(acc["at"], item), lambda r: F.struct(
            r["state"].alias("at"), F.concat(acc["out"], F.array(r["y"])).alias("out")))

    def folded(x: Column, at: Column, level: int) -> Column:
        if not level:
            return F.aggregate(x, F.struct(at.alias("at"), none.alias("out")), one)
        size = F.greatest(F.ceil(F.pow(F.size(x), F.lit(level / (level + 1)))).cast("int"), F.lit(1))
        parts = let(size, lambda n: F.transform(F.sequence(F.lit(0), F.ceil(F.size(x) / n).cast("int") - 1),
                                                lambda i: F.slice(x, i * n + 1, n)))

        def part(acc: Column, p: Column) -> Column:
            return let(folded(p, acc["at"], level - 1), lambda r: F.struct(
                r["at"].alias("at"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

        return F.aggregate(parts, F.struct(at.alias("at"), F.array().cast(f"array<{empty}>").alias("out")), part,
                           lambda acc: F.struct(acc["at"].alias("at"), F.flatten(acc["out"]).alias("out")))

    return F.when(F.size(items) > 0, let(items, lambda x: folded(x, zero, levels)["out"])).otherwise(none)


#: Signs between an identifier and the white space around it, white space, and the word that follows.
BESIDE = r"^(?:[^\p{L}\p{N}\x20\x09-\x0D]++)?+[\x20\x09-\x0D]*+([^\x20\x09-\x0D]*+)"
SPAN = "s:int,e:int,v:string"


def _plain(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), r"[^\p{L}\p{N}]", "")


def matches(text: Column, pattern: str, holds=None, neighbours: bool = False) -> Column:
    """array<struct<s, e, v>> of the leftmost non-overlapping matches that hold, in code points, end exclusive.

    With ``neighbours`` also ``left`` and ``right``, the words beside a match, whole ones of any length in small
    letters without signs.  A neighbour is looked for up to the next but one match of the pattern on its side,
    so every character is looked at a bounded number of times.
    """
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
                    F.split(text, pattern, -1).alias("gaps"))
    fields = SPAN + (",left:string,right:string" if neighbours else "")
    none = F.array().cast(f"array<struct<{fields}>>")

    def placed(b: Column) -> Column:
        lengths = F.transform(b["m"], lambda v, i: F.struct(F.length(F.get(b["gaps"], i)).alias("g"), F.length(v).alias("n")))
        starts = running(lengths, F.lit(0), lambda at, x: F.struct(
            (at + x["g"] + x["n"]).alias("state"), (at + x["g"]).alias("y")), "array<int>")

        def piece(i: Column) -> Column:
            return F.coalesce(F.get(b["gaps"], i), F.lit(""))

        def match(i: Column) -> Column:
            return F.coalesce(F.when(i >= 0, F.get(b["m"], i)), F.lit(""))

        def whole(at: Column) -> Column:
            found = F.filter(F.transform(b["m"], lambda v, i: F.struct(i.alias("i"), F.get(at, i).alias("s"), v.alias("v"))),
                             lambda x: holds(x["v"]) if holds else F.lit(True))

            def span(x: Column) -> Column:
                i = x["i"]
                out = [x["s"].alias("s"), (x["s"] + F.length(x["v"])).alias("e"), x["v"].alias("v")]
                if neighbours:
                    before = F.concat(F.when(i > 0, piece(i - 1)).otherwise(""), match(i - 1), piece(i))
                    after = F.concat(piece(i + 1), match(i + 1), piece(i + 2))
                    out += [_plain(F.reverse(F.regexp_extract(F.reverse(before), BESIDE, 1))).alias("left"),
                            _plain(F.regexp_extract(after, BESIDE, 1)).alias("right")]
                return F.struct(*out)

            return F.transform(found, span)

        return F.when(F.size(b["m"]) > 0, let(starts, whole)).otherwise(none)

    return let(both, placed)


def base_spans(text: Column, neighbours: bool = False) -> Column:
    """array<struct<k, s, e, v>> of the fixed patterns, by kind as listed, then start."""
    fields = f"k:int,{SPAN}" + (",left:string,right:string" if neighbours else "")
    none = F.array().cast(f"array<struct<{fields}>>")
    worth = {"email": F.instr(text, "@") > 0, "phone": F.instr(text, "+") > 0}

    def of_kind(k: int, kind: str) -> Column:
        spans = matches(text, PATTERNS[kind], lambda v: _holds(kind, v), neighbours)
        found = F.transform(spans, lambda x: F.struct(F.lit(k).alias("k"), *[x[n].alias(n) for n in _names(neighbours)]))
        return F.when(worth.get(kind, text.rlike("[0-9]")), found).otherwise(none)

    return F.concat(*[of_kind(k, kind) for k, kind in enumerate(KINDS)])


def _names(neighbours: bool) -> list[str]:
    return ["s", "e", "v"] + ["left", "right"] * neighbours


def _looks_like(kind: Column, v: Column) -> Column:
    """Could the word be an identifier of this kind that the fixed pattern misses?"""
    n = F.length(_digits(v))
    letters = v.rlike(r"\p{L}")
    return (((kind == 0) & (F.instr(v, "@") > 0))
            | ((kind == 1) & (n >= 8) & (F.size(F.split(v, "[.:]")) >= 4))
            | ((kind == 2) & n.between(13, 19) & ~letters)
            | ((kind == 3) & n.between(9, 15) & ~letters))


def occurrences(text: Column) -> Column:
    """array<struct<k, s, e, v, left, right>>: seeds (k numbers KINDS), words with a digit or an at sign (WORD_OF), and
    numbers written with blanks, each as one (RUN_OF)."""
    def as_kind(spans: Column, k: int) -> Column:
        return F.transform(spans, lambda x: F.struct(F.lit(k).alias("k"), *[x[n].alias(n) for n in _names(True)]))

    none = F.array().cast(f"array<struct<k:int,{SPAN},left:string,right:string>>")
    words = as_kind(matches(text, CANDIDATE, None, True), WORD_OF)
    runs = as_kind(matches(text, RUN, lambda v: (F.instr(v, " ") > 0) & F.length(_digits(v)).between(9, 19), True), RUN_OF)
    return F.when(text.rlike("[0-9@]"), F.concat(
        base_spans(text, True), words,
        F.when(text.rlike(r"[0-9][)\].-]*\x20[\x20()\[\].-]*[0-9]"), runs).otherwise(none))).otherwise(none)


def _touches(rows: DataFrame, others: Column, name: str) -> DataFrame:
    """Adds ``name``: does a row for which ``others`` holds overlap this one in its text?  Two running extremes."""
    before = Window.partitionBy("id", "id2").orderBy("s").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy("id", "id2").orderBy(F.desc("s")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reach, ahead = F.max(F.when(others, F.col("e"))).over(before), F.min(F.when(others, F.col("s"))).over(after)
    return rows.withColumn(name, F.coalesce(reach > F.col("s"), F.lit(False)) | F.coalesce(ahead < F.col("e"), F.lit(False)))


def _occurrences(docs: DataFrame) -> DataFrame:
    """(id, id2, k, s, e, v, left, right) of ``occurrences``, every row once; k null for candidates.

    Candidates are those that no seed touches; a word that is a part of a number written with blanks is none,
    unless it has digits enough to be an identifier itself.
    """
    rows = docs.select("id", "id2", F.explode("spans").alias("x")).select("id", "id2", "x.*").distinct()
    rows = _touches(_touches(rows, F.col("k") < WORD_OF, "_seeded"), F.col("k") == RUN_OF, "_in_run")
    alone = (F.instr("v", "@") > 0) | (F.length(_digits(F.col("v"))) >= 8) | ~F.col("_in_run")
    free = ~F.col("_seeded") & ((F.col("k") == RUN_OF) | alone)
    return (rows.filter((F.col("k") < WORD_OF) | free).drop("_seeded", "_in_run")
            .withColumn("k", F.when(F.col("k") < WORD_OF, F.col("k"))))


def _patterns(rows: DataFrame) -> DataFrame:
    """One row for each lexical pattern of an occurrence: the word before, the word after, both."""
    none = F.lit(None).cast("string")
    has_l, has_r = F.length("left") > 0, F.length("right") > 0
    options = F.array(F.when(has_l, F.concat(F.lit("L:"), "left")).otherwise(none),
                      F.when(has_r, F.concat(F.lit("R:"), "right")).otherwise(none),
                      F.when(has_l & has_r, F.concat_ws(" ", F.lit("B:"), "left", "right")).otherwise(none))
    return rows.withColumn("p", F.explode(options)).filter("p is not null")


def bootstrap(occurrences: DataFrame, rounds: int = ROUNDS, min_confidence: float = MIN_CONFIDENCE,
              min_seeds: int = MIN_SEEDS) -> DataFrame:
    """-> (v, k, confidence): words that trusted patterns point to, with their kind.

    The graph has one edge for each pattern and identifier, weighted by occurrences; it is aggregated
    before it is joined.  A pattern's confidence for a kind is the weight of its identifiers known to
    be of the kind over the weight of all, plus one; a pattern needs ``min_seeds`` different seeds.  An identifier's
    confidence is one minus the product of its patterns' doubts; it decides nothing below
    ``min_confidence``.
    """
    edges = landed(_patterns(occurrences).groupBy("p", "v").agg(F.count("*").cast("double").alias("w"), F.max("k").alias("seed")),
                   "pii-graph")
    total = edges.groupBy("p").agg(F.sum("w").alias("all"))
    seeds = edges.filter("seed is not null").select("v", F.col("seed").alias("k")).distinct()
    support = (edges.join(seeds, "v").groupBy("p", "k").agg(F.count("*").alias("n"))
               .filter(F.col("n") >= min_seeds).select("p", "k"))
    known = seeds.withColumn("confidence", F.lit(1.0))
    unseen = edges.join(seeds.select("v"), "v", "left_anti")
    found = None
    for _ in range(rounds):
        scored = (edges.join(known, "v").groupBy("p", "k").agg(F.sum(F.col("w") * F.col("confidence")).alias("good"))
                  .join(support, ["p", "k"]).join(total, "p")
                  .select("p", "k", (F.col("good") / (F.col("all") + 1)).alias("pc")).filter(F.col("pc") >= 0.5))
        found = (unseen.join(scored, "p").filter(_looks_like(F.col("k"), F.col("v"))).groupBy("v", "k")
                 .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("pc"), F.lit(1e-9)))))).alias("confidence"))
                 .filter(F.col("confidence") >= min_confidence))
        found = found.checkpoint()
        known = seeds.withColumn("confidence", F.lit(1.0)).unionByName(found)
    return found.groupBy("v").agg(F.max_by("k", F.struct("confidence", -F.col("k"))).alias("k"),
                                  F.max("confidence").alias("confidence"))


def find_personal_data(docs: DataFrame, **settings) -> DataFrame:
    """Adds ``base`` and ``found``, arrays of struct(k, s, e, v): spans of the fixed patterns and of all.

    ``k`` numbers KINDS; spans are code points, end exclusive, by kind and then start.  A null text
    has none.  Rows that share doc_id and text share their spans; all input columns stay, but for
    columns that have the names of the result.
    """
    key = {"_id": F.xxhash64("doc_id", "text"), "_id2": F.hash("text", "doc_id")}
    text = F.coalesce("text", F.lit(""))
    # regular expressions run in the scan; what is shuffled later are a few spans
    seen = landed(_occurrences(docs.select(key["_id"].alias("id"), key["_id2"].alias("id2"), occurrences(text).alias("spans"))),
                  "pii-occurrences")
    new = bootstrap(seen, **settings)
    # a found number is listed once, as a whole: what starts later and ends no later lies in another
    wider = Window.partitionBy("_id", "_id2").orderBy("s", F.desc("e")).rowsBetween(Window.unboundedPreceding, -1)
    extra = (seen.filter("k is null").select(F.col("id").alias("_id"), F.col("id2").alias("_id2"), "s", "e", "v").distinct()
             .join(new, "v").withColumn("_reach", F.max("e").over(wider))
             .filter("_reach is null or _reach < e").groupBy("_id", "_id2")
             .agg(F.collect_list(F.struct("k", "s", "e", "v")).alias("_extra")))
    out = docs.withColumns(key).withColumn("base", base_spans(text)).join(extra, ["_id", "_id2"], "left")
    return (out.withColumn("found", F.sort_array(F.concat("base", F.coalesce("_extra", F.array().cast(
        "array<struct<k:int,s:int,e:int,v:string>>"))))).drop("_id", "_id2", "_extra"))


def spans_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def pii_digests(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, text, ...) -> (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), one row per input row."""
    found = find_personal_data(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), **settings)

    def number(k: int) -> Column:
        return F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")

    return found.select(
        "doc_id", *[number(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.col("found")).alias("spans"))


def mask_personal_data(docs: DataFrame, **settings) -> DataFrame:
    """The documents with every found span replaced by its kind in capitals and brackets; columns as before.

    Of overlapping spans the one that starts first is replaced, at equal starts the longest; ``n_chars``
    follows the new text where the table has that column.
    """
    found = find_personal_data(docs, **settings)
    labels = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    order = F.sort_array(F.transform("found", lambda x: F.struct(
        x["s"].alias("s"), (-x["e"]).alias("e"), x["k"].alias("k"))))

    def replaced(p: Column) -> Column:
        # from -> to of the gap before each span, -1 for a span that another one covers
        cuts = running(p["spans"], F.lit(0), lambda at, x: F.struct(
            F.when(x["s"] < at, at).otherwise(-x["e"]).alias("state"),
            F.struct(at.alias("a"), F.when(x["s"] < at, -1).otherwise(x["s"]).alias("b"), (-x["e"]).alias("e"),
                     x["k"].alias("k")).alias("y")), "array<struct<a:int,b:int,e:int,k:int>>")

        def cut(a: Column, b: Column) -> Column:
            first, last = F.floor(a / BLOCK).cast("int"), F.floor(b / BLOCK).cast("int")
            head, tail = F.get(p["blocks"], first), F.coalesce(F.get(p["blocks"], last), F.lit(""))
            return F.when(first == last, F.substr(F.coalesce(head, F.lit("")), a % BLOCK + 1, b - a)).otherwise(F.concat(
                F.substr(head, a % BLOCK + 1, F.lit(BLOCK)),
                F.array_join(F.slice(p["blocks"], first + 2, last - first - 1), ""), F.substr(tail, F.lit(1), b % BLOCK)))

        def joined(c: Column) -> Column:
            kept = F.filter(c, lambda x: x["b"] >= 0)
            parts = F.transform(kept, lambda x: F.concat(cut(x["a"], x["b"]), F.get(labels, x["k"])))
            end = F.element_at(kept, -1)["e"]
            return F.concat(F.array_join(parts, ""), cut(end, p["n"]))

        return let(cuts, joined)

    whole = F.struct(order.alias("spans"), F.length("text").alias("n"),
                     F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % BLOCK), F.lit(0)).alias("blocks"))
    masked = F.when(F.size("found") > 0, let(whole, replaced)).otherwise(F.col("text"))
    out = found.withColumn("text", masked)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
