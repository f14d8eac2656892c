"""Quality rules: a table of thresholds compiled into one projection.

``RULES`` names a measure, the least and the greatest value it may have, and from how many
words on the rule holds. ``measure`` computes all measures with built-in functions only,
``judge`` turns the table into one boolean expression. Nothing is shuffled, no function of
the user's runs, and every row is judged by itself, so a hot source changes nothing.

Defined results: a null text counts as empty and fails, as it has too few words; repeated
rows are judged one by one; an empty table gives an empty result; columns of the input are
never read besides the named ones, so clashing names do no harm.

Windows of three words are compared by a 64-bit hash inside one text.

A rule on stop words is left out for texts whose language, where a column of it is named, has
no list; the other rules decide there.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import SPACE_CLASS, split_words, whole

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Languages that ``STOP_WORDS`` has words of; in others a rule on stop words says nothing.
STOP_LANGUAGES = ("en", "fr", "de", "es")
#: The commonest function words of these languages.
STOP_WORDS = (
    "the of and to in a is that it for was on as with be by are this at from or an "
    "le la les de des et en un une que qui dans du est pour au il elle "
    "der die das und den ein eine von zu mit ist nicht auf im für sich dem "
    "el los las y que por con para del se una es no su lo"
).split()


class Rule(NamedTuple):
    """``low <= measure <= high`` from ``from_words`` words on; None is open."""

    measure: str
    low: float | None
    high: float | None
    from_words: int = 0


RULES = (
    Rule("mean_word_chars", 2.0, 12.0),
    Rule("symbol_ratio", None, 0.08),
    Rule("stop_ratio", 0.04, None),
    Rule("dup_line_ratio", None, 0.5),
    Rule("repeat_ratio", None, 0.5),
)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row the id, the columns in ``keep`` and all counts and ratios the rules may name."""
    taken = [F.col(id_col).alias(id_col), *(F.col(c) for c in keep if c != id_col)]
    names = [id_col, *(c for c in keep if c != id_col)]
    texts = docs.select(*taken, whole(F.col(text_col)).alias("__t"))
    words = texts.select(
        *names,
        split_words(F.col("__t")).alias("__w"),
        F.filter(F.split("__t", "\n"), lambda line: line.rlike(f"[^{SPACE_CLASS}]")).alias("__l"),
        (F.length("__t") - F.length(F.regexp_replace("__t", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
    )
    n = F.size("__w")
    starts = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    w = F.col("__w")
    sorted_windows = words.select(
        *names, "n_symbols", "__w", "__l",
        F.sort_array(
            F.transform(
                starts,
                lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
            )
        ).alias("__windows"),
    ).select(
        # always true, but not to the optimizer, which therefore leaves this column where it is;
        # written into a later filter, each step of a lambda would compute the array anew
        *names, "n_symbols", "__w", "__l", F.when(F.monotonically_increasing_id() >= 0, F.col("__windows")).alias("__s"),
    )
    s = F.col("__s")

    def again(x: Column, j: Column) -> Column:
        return (x["h"] == F.get(s, j + 1)["h"]) | (x["h"] == F.get(s, j - 1)["h"])

    repeated = F.flatten(F.transform(F.filter(s, again), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    counts = sorted_windows.select(
        *names, "n_symbols",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.size("__l").cast("long").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(repeated)).cast("long").alias("n_repeat_words"),
        F.size(F.filter("__w", lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
    )

    def ratio(part: str, total: str) -> Column:
        return F.when(F.col(total) > 0, F.col(part) / F.col(total)).otherwise(F.lit(0.0))

    return counts.select(
        "*",
        ratio("word_chars", "n_words").alias("mean_word_chars"),
        ratio("n_symbols", "word_chars").alias("symbol_ratio"),
        ratio("n_stop_words", "n_words").alias("stop_ratio"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        ratio("n_repeat_words", "n_words").alias("repeat_ratio"),
    )


def compile_rules(rules: tuple[Rule, ...] = RULES, lang_col: str | None = None) -> Column:
    """One boolean column: every rule of the table holds."""
    tests = [F.lit(True)]
    listed = F.coalesce(F.col(lang_col).isin(*STOP_LANGUAGES), F.lit(False)) if lang_col else F.lit(True)
    for rule in rules:
        value = F.col(rule.measure)
        inside = reduce(
            and_,
            [F.lit(True)]
            + ([value >= rule.low] if rule.low is not None else [])
            + ([value <= rule.high] if rule.high is not None else []),
        )
        holds = or_(F.col("n_words") < rule.from_words, inside)
        tests.append(holds | ~listed if rule.measure == "stop_ratio" else holds)
    return reduce(and_, tests)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judge(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text",
    keep: tuple[str, ...] = (), lang_col: str | None = None,
) -> DataFrame:
    """``measure`` with ``base_failed`` and ``kept``."""
    kept = (*keep, lang_col) if lang_col and lang_col not in keep else keep
    return measure(docs, id_col, text_col, kept).select(
        "*", base_failed().alias("base_failed"), (~base_failed() & compile_rules(rules, lang_col)).alias("kept")
    )


def accepted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows that the rules keep, with their own columns; decided row by row, no join. The
    column of the language is used where ``docs`` has one."""
    whole_row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row")
    rows = docs.select(whole_row, F.col(text_col).alias("__text"))
    lang = None
    if lang_col in docs.columns:
        rows, lang = rows.withColumn("__lang", F.col(f"__row.`{lang_col}`").cast("string")), "__lang"
    return judge(rows, rules, "__row", "__text", lang_col=lang).filter("kept").select("__row.*")
