"""Quality rules as a short-circuit cascade of SQL expressions.

Every rule is an expression that is true where it rejects a text. A bounded sample tells how
long each rule takes and how much it rejects; the rules then run in the order of rejections
per second, as the branches of one CASE, so a rule runs only on what all before it let pass.
The order changes the time and the rule named, never which texts stay.

Defined results: a null or empty text has no words and is rejected as too short; an empty
table gives an empty result; repeated rows are judged alike; further columns are left alone.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from townhall.llm.expressions import let, up_to
from townhall.llm.frames import id_and_text
from townhall.llm.syncmers import _UNSPACED as UNSPACED

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
# fixed: punctuation and letters shared by scripts that are written without spaces
UNSPACED_SIGNS = r"[\u2010-\u2027\u3000-\u303F\u30FB-\u30FC\uFF00-\uFF65]"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SAMPLE_ROWS = 2000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS + "+", ""))).cast("long")


def unspaced(text: Column) -> Column:
    """Characters of scripts that are written without spaces between words."""
    return F.length(text) - F.length(F.regexp_replace(text, UNSPACED + "+", ""))


def spaced_words(text: Column) -> Column:
    """Words of the scripts that have spaces: those without them part words as a space does."""
    return words_of(F.regexp_replace(text, f"(?:{UNSPACED}|{UNSPACED_SIGNS})+", " "))


def long_words(text: Column, words: Column) -> Column:
    """Whether words are too long on average, as far as white space tells what a word is."""
    too_long = lambda w: word_chars(w) > 15 * F.size(w)
    # the second is worked out only where the first holds
    return F.when(too_long(words), F.when(text.rlike(UNSPACED), let(spaced_words(text), too_long)).otherwise(F.lit(True))
                  ).otherwise(F.lit(False))


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def duplicate_lines(text: Column) -> Column:
    return let(worded_lines(text), lambda v: F.size(v) - F.size(F.array_distinct(v))).cast("long")


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more; windows are told apart by 64 bits.

    Texts without such a window, most of them, are settled by one distinct count. The others
    sort their windows; equal neighbours are repeated, and the words they cover are added up.
    """

    def covered(ordered: Column) -> Column:
        same = lambda x, other: F.coalesce(F.get(ordered, other)["key"] == x["key"], F.lit(False))
        repeated = F.filter(ordered, lambda x, i: same(x, i - 1) | same(x, i + 1))
        starts = F.sort_array(F.transform(repeated, lambda x: x["at"]))
        begin = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(
            starts, begin,
            lambda acc, at: F.struct((acc["n"] + F.least(F.lit(3), at - acc["last"])).alias("n"), at.alias("last")),
            lambda acc: acc["n"],
        )

    def counted(keys: Column) -> Column:
        ordered = F.sort_array(F.transform(keys, lambda x, i: F.struct(x.alias("key"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0)).otherwise(let(ordered, covered))

    keys = F.transform(
        up_to(F.size(words) - 2), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    )
    return let(keys, counted).cast("long")


@dataclass(frozen=True)
class Rule:
    """A name and what rejects: a function of the text and of the array of its words."""

    name: str
    rejects: Callable[[Column, Column], Column]


def _letters(text: Column, kind: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, kind + "+", ""))


BASE_RULES = [
    Rule("few_words", lambda text, words: F.size(words) < MIN_WORDS),
    Rule("repeated_words", lambda text, words: 100 * repeated_words(words) > MAX_REPEATED_PERCENT * F.size(words)),
]

# Set far from clean prose of any length and language; a character of a script without spaces counts as a word.
FURTHER_RULES = [
    Rule("symbols", lambda text, words: let(10 * symbols(text), lambda n: F.when(
        n > F.size(words), n > F.size(words) + unspaced(text)).otherwise(F.lit(False)))),
    Rule("long_words", long_words),
    Rule("short_words", lambda text, words: 2 * word_chars(words) < 5 * F.size(words)),
    Rule("letterless_words", lambda text, words: 10 * F.size(F.filter(words, lambda w: w.rlike(r"\p{L}")))
         < 7 * F.size(words)),
    Rule("capitals", lambda text, words: 2 * _letters(text, r"\p{Lu}") > _letters(text, r"\p{L}")),
    Rule("exclamations", lambda text, words: let(2 * _letters(text, "!"), lambda n: F.when(
        n > F.size(words), n > F.size(words) + unspaced(text)).otherwise(F.lit(False)))),
    Rule("duplicate_lines", lambda text, words: let(
        worded_lines(text), lambda v: 2 * F.size(F.array_distinct(v)) < F.size(v))),
]


def cascade(rules: list[Rule], text: Column, words: Column) -> Column:
    """The first rule that rejects, by name; null where none does."""
    out = F
    for rule in rules:
        out = out.when(rule.rejects(text, words), F.lit(rule.name))
    return out.otherwise(F.lit(None).cast("string"))


def in_order(texts: DataFrame, rules: list[Rule], rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejections per second, measured on about ``rows`` rows of a column ``text``."""
    total = texts.count()
    if not total:
        return rules
    sample = texts.select("text").sample(min(1.0, rows / total), seed=7).limit(2 * rows).cache()
    try:
        n = max(sample.count(), 1)
        empty = min(_timed(sample, lambda text, words: F.size(words) < 0)[1] for _ in range(2))
        scored = []
        for rule in rules:
            runs = [_timed(sample, rule.rejects) for _ in range(2)]
            seconds = max(min(t for _, t in runs) - empty, 1e-3)
            scored.append(((runs[0][0] / n) / seconds, rule))
    finally:
        sample.unpersist()
    return [rule for _, rule in sorted(scored, key=lambda x: -x[0])]


def _timed(sample: DataFrame, rejects: Callable[[Column, Column], Column]) -> tuple[int, float]:
    start = time.perf_counter()
    text = F.col("text")
    rejected = sample.agg(F.count_if(let(words_of(text), lambda w: rejects(text, w)))).first()[0]
    return rejected, time.perf_counter() - start


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, rejected_by (a rule or null) and kept."""
    plain = id_and_text(docs, id_col, text_col)
    text, words = F.col("text"), F.col("words")
    worded = plain.withColumn("words", words_of(text))
    further = cascade(in_order(plain, FURTHER_RULES), text, words)
    counted = worded.select(
        "doc_id", "text", "words", F.size(words).cast("long").alias("n_words"), word_chars(words).alias("word_chars"),
        symbols(text).alias("n_symbols"), duplicate_lines(text).alias("n_dup_lines"),
        repeated_words(words).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    found = counted.withColumn("base_failed", failed).withColumn(
        "rejected_by", F.when(F.col("base_failed"), F.lit("base")).otherwise(further)
    )
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "rejected_by", F.col("rejected_by").isNull().alias("kept"),
    )


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows that no rule rejects, base rules and all in one cascade."""
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    texts = own.withColumn("text", F.coalesce(F.col(f"row.`{text_col}`"), F.lit("")))
    text, rules = F.col("text"), in_order(texts, BASE_RULES + FURTHER_RULES)
    # the words are bound inside the one expression, as a filter is moved below any column
    return texts.where(let(words_of(text), lambda w: cascade(rules, text, w)).isNull()).select("row.*")
