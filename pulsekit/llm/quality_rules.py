"""Line-first cleaning, in DataFrame functions only.

Rules are judged line by line; lines that fail are removed, and a document that
loses too much of its text goes.  The counts of the base rules come from the
same pass; there is no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import count_chars, let, words

SYMBOLS = r"#*$%&|<>"
#: Any character of a word.
WORD = r"[^\x20\x09-\x0D]"
SEPARATORS = "|»›•·¦"
#: A line fails beyond one symbol in ten characters, or without a letter or digit.
SYMBOL_SHARE = 10
#: Separators in a navigation line: three at least, and one for every four words.
NAV_SEPARATORS, NAV_WORDS = 3, 4
#: Navigation entries, matched against whole lines.
NAV_ENTRIES = (r"^(?:home|menu|main menu|skip to (?:main )?content|back to top|log ?in|log ?out|sign ?in|sign ?up|register"
               r"|search|next|previous|prev|older posts?|newer posts?|read more|more|share|tweet|print|contact(?: us)?"
               r"|about(?: us)?|site ?map|faq|help|privacy policy|terms (?:of (?:use|service)|and conditions))$")
#: Boilerplate phrases; a line fails where they are a sixth of it.
BOILERPLATE = (r"all rights reserved|copyright ©|© ?(?:19|20)[0-9][0-9]|(?:use[sd]?|accept|enable) (?:of )?cookies"
               r"|cookie policy|privacy policy|terms of (?:use|service)|enable javascript|javascript is disabled"
               r"|subscribe to our|sign up for our|follow us on|share (?:this )?on (?:facebook|twitter)|click here to"
               r"|powered by wordpress|lorem ipsum")
BOILERPLATE_SHARE = 6
#: Marks of any script; a line fails where they are two fifths of its word characters, as in rules, tables and bare bullets.
MARKS, MARK_SHARE = r"[\p{P}\p{S}]", 40
MIN_WORDS, MAX_REPEATED, MIN_KEPT = 50, 50, 50


def n_repeat_words(w: Column) -> Column:
    """Words in three-word windows that the text has twice or more, each word once.

    Windows are compared by 64-bit hashes; sorting them with their places finds equal ones.
    """
    hashed = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    windows = F.slice(hashed, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0)))

    def covered(g: Column) -> Column:
        def places(s: Column) -> Column:
            again = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))
            return F.size(F.array_distinct(F.flatten(
                F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

        ordered = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(ordered, places))

    return let(windows, covered)


def line_passes(line: Column, phrases: Column) -> Column:
    """Punctuation, navigation and boilerplate rules of one line; a blank line passes.

    ``phrases`` tells whether the document has a boilerplate phrase at all.
    """
    low = F.lower(F.trim(line))
    symbols = (count_chars(line, SYMBOLS) * SYMBOL_SHARE > F.length(line)) | ~line.rlike(r"[\p{L}\p{N}]")
    solid = F.regexp_replace(line, r"[\x20\x09-\x0D]+", "")
    marks = 100 * (F.length(solid) - F.length(F.regexp_replace(solid, MARKS, ""))) >= MARK_SHARE * F.length(solid)
    separators = count_chars(line, SEPARATORS)
    navigation = ((separators >= NAV_SEPARATORS) & (separators * NAV_WORDS >= F.size(words(line)))) | low.rlike(NAV_ENTRIES)
    said = F.length(low) - F.length(F.regexp_replace(low, BOILERPLATE, ""))
    boilerplate = phrases & low.rlike(BOILERPLATE) & (said * BOILERPLATE_SHARE >= F.length(F.trim(line)))
    return ~line.rlike(WORD) | ~(symbols | marks | navigation | boilerplate)



def quality_rules(docs: DataFrame, min_words: int = MIN_WORDS, max_repeated: int = MAX_REPEATED,
                  min_kept: int = MIN_KEPT) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and clean_text.

    Words are runs of other characters than space and U+0009 to U+000D.  ``clean_text`` is the text
    without the lines that fail; ``kept`` is false for ``base_failed`` documents (under ``min_words``
    words, or over ``max_repeated`` percent repeated ones) and where under ``min_kept`` percent of the
    word characters are left.  A null text has no words and fails; its clean text is null.  Input
    columns stay as they are; result columns replace input columns of the same name.
    """
    text = F.coalesce("text", F.lit(""))
    phrases = F.lower(text).rlike(BOILERPLATE)
    clean = F.when(F.col("text").isNotNull(), let(phrases, lambda p: F.array_join(
        F.filter(F.split(text, "\n"), lambda x: line_passes(x, p)), "\n")))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    counts = let(words(F.col("text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("chars"),
        n_repeat_words(w).cast("long").alias("repeated")))
    counted = docs.withColumns({"_counts": counts, "clean_text": clean}).withColumns({
        "n_words": F.col("_counts.n"),
        "word_chars": F.col("_counts.chars"),
        "n_symbols": count_chars(text, SYMBOLS).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": F.col("_counts.repeated"),
    }).drop("_counts")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated * F.col("n_words"))
    left = F.length(F.array_join(words(F.col("clean_text")), ""))
    enough = (F.col("clean_text") == text) | (100 * left >= min_kept * F.col("word_chars"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & F.coalesce(enough, F.lit(False)))
