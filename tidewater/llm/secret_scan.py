"""Secret scans through a trigram index, in DataFrame functions only.

Each rule's regex is read once on the driver into a Boolean trigram query: an
AND of ORs of ANDs of lower-case trigrams that every match must contain. The
index holds postings (trigram, row key) for exactly the trigrams that some query
asks for. Postings are intersected by grouping on the key; the rows left are
candidates, and the regex itself verifies them and gives spans. A rule without
mandatory trigrams (hex runs) scans every text.

Spans are in code points, end exclusive, from the gaps and matches that the
regex splits a text into.

Defined results. Null or empty text: no spans, zero counts, the digest of an
empty string. Null ids and repeated rows are scanned like any other; rows equal
in id and text share their spans. Empty table: no rows. Whole texts are scanned,
however long. Extra columns, whatever their names, are ignored or, in
``redact_secrets``, returned as they are.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from re import _constants as rc
from re import _parser as rp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.once import with_column_once


@dataclass(frozen=True)
class Rule:
    """``regex`` finds matches, leftmost and non-overlapping; one is kept where
    its ``group`` has ``least`` characters or more. ``any_case``: letters of
    ``(?i:...)`` parts. ``base`` rules come first in every listing."""

    kind: str
    regex: str
    group: int = 0
    least: int = 0
    base: bool = False


#: The base patterns, then well-known public token formats.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, True),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32, True),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)

Clause = tuple[frozenset[str], ...]  # an OR of ANDs of trigrams

#: Most strings that a run of literals and small classes may spell before it is closed.
MAX_SPELLINGS = 32


def _spellings(parsed: list) -> set[str] | None:
    """All strings that a parsed pattern can match, or None if not a small set."""
    out = {""}
    for op, arg in parsed:
        if op is rc.LITERAL:
            step: set[str] | None = {chr(arg).lower()}
        elif op is rc.IN and all(o is rc.LITERAL for o, _ in arg):
            step = {chr(a).lower() for _, a in arg}
        elif op is rc.SUBPATTERN:
            step = _spellings(list(arg[3]))
        elif op is rc.BRANCH:
            parts = [_spellings(list(p)) for p in arg[1]]
            step = None if None in parts else set().union(*parts)
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[1] == 1 and arg[0] == 0:
            one = _spellings(list(arg[2]))
            step = None if one is None else one | {""}
        else:
            step = None
        if step is None or len(out) * len(step) > MAX_SPELLINGS:
            return None
        out = {a + b for a in out for b in step}
    return out


def trigram_query(regex: str) -> list[Clause]:
    """The clauses (all must hold) that any match of ``regex`` fulfils; none: scan."""
    clauses: list[Clause] = []
    run = {""}

    def close() -> None:
        if min(map(len, run)) >= 3:
            clauses.append(tuple(sorted({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run}, key=sorted)))

    for item in rp.parse(regex):
        step = _spellings([item])
        if step is None:
            close()
            run = {""}
            if item[0] is rc.SUBPATTERN:
                continue
            low = item[1][0] if item[0] in (rc.MAX_REPEAT, rc.MIN_REPEAT) else 0
            inner = _spellings(list(item[1][2])) if low else None
            run = inner if inner and low == item[1][1] == 1 else {""}
        elif len(run) * len(step) > MAX_SPELLINGS:
            close()
            run = set(step)
        else:
            run = {a + b for a in run for b in step}
    close()
    return clauses


def _plan(rules: Sequence[Rule]) -> tuple[list[tuple[str, int, int, int, int]], dict[int, int]]:
    """Rows (trigram, rule, clause, alternative, trigrams the alternative needs),
    and the number of clauses of each indexed rule."""
    rows, clauses = [], {}
    for k, rule in enumerate(rules):
        query = trigram_query(rule.regex)
        if query:
            clauses[k] = len(query)
        for c, clause in enumerate(query):
            for a, needed in enumerate(clause):
                rows += [(t, k, c, a, len(needed)) for t in sorted(needed)]
    return rows, clauses


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text and a 128-bit key of both."""
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return d.withColumns({"k1": F.xxhash64("id", "text"), "k2": F.xxhash64(F.lit(11), "text", "id")})


def postings(keyed: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """The index: a row (trigram, k1, k2) for each queried trigram of each text."""
    low = with_column_once(keyed.select("k1", "k2", "text"), "low", F.lower("text"))
    found = [F.when(F.col("low").contains(t), F.lit(t)) for t in trigrams]
    return low.select("k1", "k2", F.explode(F.array_compact(F.array(*found))).alias("trigram"))


def candidates(keyed: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Keys whose postings fulfil a rule's trigram query: k1, k2, rules (array)."""
    rows, clauses = _plan(rules)
    spark = keyed.sparkSession
    # A literal table of a few dozen rows, fixed by the rules.
    query = spark.createDataFrame(rows, "trigram string, rule int, clause int, alternative int, needed int")
    totals = F.element_at(F.create_map(*[F.lit(x) for pair in clauses.items() for x in pair]), F.col("rule"))
    index = postings(keyed, sorted({r[0] for r in rows}))
    hits = index.join(F.broadcast(query), "trigram").distinct()
    met = hits.groupBy("k1", "k2", "rule", "clause", "alternative", "needed").count().filter("count = needed")
    whole = met.groupBy("k1", "k2", "rule").agg(F.count_distinct("clause").alias("n")).filter(F.col("n") == totals)
    return whole.groupBy("k1", "k2").agg(F.collect_set("rule").alias("rules"))


def _spans(text: Column, k: int, rule: Rule) -> Column:
    """array<struct<start, kind order, kind, end>> of one rule in one text."""
    pattern = F.lit(rule.regex)
    match = F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    gap = F.split(text, rule.regex, -1)
    steps = F.zip_with(
        F.zip_with(gap, match, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("len"))),
        value,
        lambda gm, v: F.struct(gm.gap.alias("gap"), gm.len.alias("len"), (F.length(v) >= rule.least).alias("ok")),
    )
    steps = F.filter(steps, lambda s: s.len.isNotNull())
    span = "array<struct<start: long, rank: int, kind: string, end: long>>"
    walk = F.aggregate(
        steps,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(span).alias("out")),
        lambda acc, s: F.struct(
            (acc.at + s.gap + s.len).alias("at"),
            F.when(
                s.ok,
                F.concat(
                    acc.out,
                    F.array(
                        F.struct(
                            (acc.at + s.gap).alias("start"), F.lit(k).alias("rank"), F.lit(rule.kind).alias("kind"),
                            (acc.at + s.gap + s.len).alias("end"),
                        )
                    ).cast(span),
                ),
            ).otherwise(acc.out).alias("out"),
        ),
        lambda acc: acc.out,
    )
    return F.when(text.rlike(rule.regex), walk).otherwise(F.array().cast(span))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per row of ``docs``: id, spans (array of start, rank, kind, end,
    sorted by start, then rule order), k1, k2."""
    _, clauses = _plan(rules)
    keyed = _keyed(docs, id_col, text_col)
    scans = [_spans(F.col("text"), k, r) for k, r in enumerate(rules) if k not in clauses]
    base = keyed.select("id", "k1", "k2", (F.concat(*scans) if scans else F.array()).alias("scanned"))
    wanted = candidates(keyed, rules)
    found = keyed.select("k1", "k2", "text").join(wanted, ["k1", "k2"])
    none = F.slice(_spans(F.lit(""), 0, rules[0]), F.lit(1), F.lit(0))
    verified = F.concat(
        *[F.when(F.array_contains("rules", k), _spans(F.col("text"), k, r)).otherwise(none) for k, r in enumerate(rules) if k in clauses]
    )
    # Rows equal in id and text have equal spans: one of them stands for all.
    found = found.select("k1", "k2", verified.alias("verified")).filter(F.size("verified") > 0).distinct()
    out = base.join(found, ["k1", "k2"], "left")
    spans = F.concat("scanned", F.coalesce("verified", none)) if scans else F.coalesce("verified", none)
    return out.select("id", F.sort_array(spans).alias("spans"), "k1", "k2")


def listing(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def redact_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", mark: str = "[SECRET]",
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """The rows and columns of ``docs`` with every found span replaced by ``mark``
    (overlapping spans by one mark), and ``length_col`` brought up to date."""
    found = find_secrets(docs, id_col, text_col, rules).filter(F.size("spans") > 0).select("k1", "k2", "spans").distinct()
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col(f"row.{text_col}"), F.lit(""))
    keyed = keyed.withColumns({"k1": F.xxhash64(F.col(f"row.{id_col}"), text), "k2": F.xxhash64(F.lit(11), text, F.col(f"row.{id_col}"))})
    d = keyed.join(found, ["k1", "k2"], "left")
    walk = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc.at, s.end).alias("at"),
            F.when(s.start >= acc.at, F.concat(acc.out, F.substring(text, (acc.at + 1).cast("int"), (s.start - acc.at).cast("int")), F.lit(mark)))
            .otherwise(acc.out).alias("out"),
        ),
        lambda acc: F.concat(acc.out, F.substring(text, (acc.at + 1).cast("int"), F.length(text))),
    )
    d = d.withColumn("clean", F.when(F.size("spans") > 0, walk).otherwise(F.col(f"row.{text_col}")))
    out = []
    for c in docs.columns:
        col = F.col(f"row.`{c}`")
        if c == text_col:
            col = F.col("clean")
        elif c == length_col:
            col = F.when(F.size("spans") > 0, F.length("clean").cast(docs.schema[c].dataType)).otherwise(col)
        out.append(col.alias(c))
    return d.select(*out)


def python_matches(text: str, rule: Rule) -> list[tuple[int, int]]:
    """Brute-force spans of one rule, for tests."""
    return [m.span() for m in re.finditer(rule.regex, text) if len(m[rule.group]) >= rule.least]
