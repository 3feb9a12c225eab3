"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

Words are maximal runs of characters other than space and the controls 9 to 13. Defined results: a null or empty
text has no words and fails the base rules; repeated rows are judged alike and all returned; other columns of the
input are ignored. All work is linear in a text's length but for one sort of its three-word windows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import texts

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Frequent function words of the four languages; prose without any is a list, a table or noise.
STOP_WORDS = "the of and to in is that it with for de la le les et des que en un une est pour el los y las del der die und das den von zu ist nicht mit".split()


@dataclass(frozen=True)
class Rule:
    """A document is kept where low <= numerator / denominator <= high; a bound that is None doesn't hold; 0 / 0 passes."""

    name: str
    numerator: str
    denominator: str
    low: float | None
    high: float | None


RULES = (
    Rule("mean_word_chars", "word_chars", "n_words", 2, 15),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 0.1),
    Rule("stop_word_share", "n_stop_words", "n_words", 0.02, None),
    Rule("duplicate_line_share", "n_dup_lines", "n_lines", None, 0.5),
    Rule("bullet_line_share", "n_bullet_lines", "n_lines", None, 0.9),
    Rule("ellipsis_line_share", "n_ellipsis_lines", "n_lines", None, 0.3),
)


def let(value: Column, body) -> Column:
    """body(value) with value computed once for a row."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, n: Column) -> Column:
    """Words inside three-word windows that occur at least twice, first occurrences included.

    Windows are compared by a 64-bit hash with their positions; equal ones are neighbours after one sort.
    """

    def covered(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        twice = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    at = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    return F.when(n >= 3, let(F.sort_array(at), covered)).otherwise(0)


def measures(text: Column) -> Column:
    """A struct of the counts that rules refer to."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, " \t\n\x0b\f\r", "")) > 0)
    n_of = lambda xs, p: F.size(F.filter(xs, p))

    def counted(w: Column) -> Column:
        n = F.size(w)
        return F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            repeated_words(w, n).cast("long").alias("n_repeat_words"),
            n_of(w, lambda x: F.lower(x).isin(*STOP_WORDS)).cast("long").alias("n_stop_words"),
        )

    def by_line(xs: Column) -> Column:
        start = lambda x: F.substring(F.ltrim(x), 1, 1)
        return F.struct(
            F.size(xs).cast("long").alias("n_lines"),
            (F.size(xs) - F.size(F.array_distinct(xs))).cast("long").alias("n_dup_lines"),
            n_of(xs, lambda x: start(x).isin("-", "*", "•")).cast("long").alias("n_bullet_lines"),
            n_of(xs, lambda x: x.endswith("...") | x.endswith("…")).cast("long").alias("n_ellipsis_lines"),
        )

    return F.struct(let(words, counted).alias("w"), let(lines, by_line).alias("l"))


def compiled(rules: tuple[Rule, ...], of) -> Column:
    """One boolean for the whole table; products instead of quotients, so that no denominator can be zero."""
    ok = F.lit(True)
    for r in rules:
        num, den = of(r.numerator), of(r.denominator)
        if r.low is not None:
            ok = ok & (num >= den * F.lit(float(r.low)))
        if r.high is not None:
            ok = ok & (num <= den * F.lit(float(r.high)))
    return ok


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the counts, base_failed and kept, for every row of docs."""
    got = texts(docs).select("doc_id", measures(F.col("text")).alias("m"))
    names = {"w": ("n_words", "word_chars", "n_symbols", "n_repeat_words", "n_stop_words"), "l": ("n_lines", "n_dup_lines", "n_bullet_lines", "n_ellipsis_lines")}
    got = got.select("doc_id", *(F.col(f"m.{k}.{x}").alias(x) for k, xs in names.items() for x in xs))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return got.withColumn("base_failed", base).withColumn("kept", ~base & compiled(rules, F.col))
