"""Quality rules: a threshold table compiled into one Spark projection.

Every metric is a built-in expression over the whole text; no user function
runs. Words are ``[^\\x20\\x09-\\x0D]+``.

Defined results. A null or empty text has no words: all counts 0, ratios 0,
``base_failed`` true, ``kept`` false. A null id passes through. Repeated rows
are measured one by one. An empty table gives no rows. Extra columns of the
input, whatever their names, neither change nor enter the result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.once import with_column_once

WORD = r"[^\x20\x09-\x0D]+"
SEPARATORS = r"[\x20\x09-\x0D]+"
NOT_SYMBOLS = r"[^#*$%&|<>]+"
NOT_SHOUTS = r"[^!?]+"

#: Frequent function words of the corpus's languages (en, de, fr, es).
STOP_WORDS = (
    "the of and to in a is that it was for on are as with be by this from at or an "
    "der die und das zu den mit von ist des ein eine dem im nicht auf sich als auch "
    "le la les de et en un une est que qui dans du pour pas au avec sur "
    "el los las y se del con por para su al lo como es"
).split()


@dataclass(frozen=True)
class Rule:
    """A document passes when ``low <= metric <= high`` (a null bound is open)."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: The method's thresholds, over metrics of ``METRICS``.
RULES = (
    Rule("mean_word_length", "mean_word_length", 2.0, 12.0),
    Rule("symbols_per_word", "symbol_ratio", None, 0.2),
    Rule("shouts_per_word", "shout_ratio", None, 0.75),
    Rule("stop_words", "stop_word_ratio", 0.02, None),
    Rule("repeated_lines", "dup_line_ratio", None, 0.5),
)

METRICS = ("mean_word_length", "symbol_ratio", "shout_ratio", "stop_word_ratio", "dup_line_ratio")

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _measured(rows: DataFrame) -> DataFrame:
    """Add the counts to ``rows`` (columns ``row``, ``text``); drops ``text``."""
    text = F.coalesce("text", F.lit(""))
    d = with_column_once(rows.withColumn("text", text), "w", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    # Hash of the three-word window that begins at each word.
    window = F.transform("w", lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)))
    d = with_column_once(d, "h", F.slice(window, F.lit(1), F.greatest(F.size("w") - 2, F.lit(0))))
    # Only texts that repeat a window sort their windows.
    pairs = F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    none = F.slice(pairs, F.lit(1), F.lit(0))
    d = with_column_once(d, "s", F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(pairs)).otherwise(none))
    again = F.filter("s", lambda x, k: (F.get("s", k - 1).h == x.h) | (F.get("s", k + 1).h == x.h))
    covered = F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x.i, x.i + 1, x.i + 2))))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = with_column_once(d, "lines", lines)
    return d.select(
        "row",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", SEPARATORS, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", NOT_SYMBOLS, "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(covered).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("text", NOT_SHOUTS, "")).cast("long").alias("n_shouts"),
        F.size(F.filter("w", lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
    )


def compile_rules(rules: tuple[Rule, ...] = RULES) -> list[Column]:
    """The rule table as one list of expressions: ratios, failed names, verdict."""
    n = F.col("n_words")
    metric = {
        "mean_word_length": _ratio(F.col("word_chars"), n),
        "symbol_ratio": _ratio(F.col("n_symbols"), n),
        "shout_ratio": _ratio(F.col("n_shouts"), n),
        "stop_word_ratio": _ratio(F.col("n_stop_words"), n),
        "dup_line_ratio": _ratio(F.col("n_dup_lines"), F.col("n_lines")),
    }
    base_failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    failed = []
    for r in rules:
        m = metric[r.metric]
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | (m < F.lit(float(r.low)))
        if r.high is not None:
            bad = bad | (m > F.lit(float(r.high)))
        failed.append(F.when(bad, F.lit(r.name)))
    names = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    return [
        *(metric[m].alias(m) for m in METRICS),
        base_failed.alias("base_failed"),
        names.alias("failed_rules"),
        (~base_failed & (F.size(names) == 0)).alias("kept"),
    ]


def judge(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All columns of ``docs`` as ``row``, with counts, ratios and the verdict."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    return _measured(rows).select("*", *compile_rules(rules))


def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    return judge(docs, text_col, rules).filter("kept").select("row.*")
