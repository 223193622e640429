"""Licence scans by a positional rare-token index, in DataFrame functions only.

Templates are short public licence notices. Their words are indexed by position:
word -> (template, position). How rare a licence word is comes from its document
frequency over the whole corpus; each template is looked up by its rare words
and by the rarest words of each mandatory key phrase, as many as a start needs
votes, so a whole key phrase reaches the votes at every frequency. For every file, the rare licence words it holds are looked up, each hit
votes for (template, start = place in file - place in template), and starts with
two or more votes are candidates. A candidate counts only where a mandatory key
phrase of its template stands at its exact place; its score is the share of the
template's words found in place. Templates and their vocabulary are fixed, so
the index is a literal in the plan and no text is shuffled.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing. Lower-casing
beyond A-Z changes neither word bounds nor any word that the templates hold.

Defined results. Null or empty text: no words, empty label lists, score 0,
places null. Null ids and repeated rows are scanned like any other. Overlapping
places all count. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.once import with_column_once

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Label of each base phrase.
BASE = {"mit": ("mit", "license"), "apache": ("apache", "license"), "gpl": ("general", "public", "license")}
#: The word that all base phrases end in.
LAST = "license"

#: A template is looked up by its words that at most this share of the corpus holds,
#: and by as many of its rarest ones in any case; votes that make a candidate.
RARE_SHARE = 0.05
ANCHORS = 4
VOTES = 2


def tokens(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


@dataclass(frozen=True)
class Template:
    """``phrases``: any one of them must stand at its place in the template."""

    label: str
    text: str
    phrases: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return tokens(self.text)

    @property
    def places(self) -> list[list[int]]:
        """Template positions of each phrase's words."""
        w, out = self.words, []
        for phrase in self.phrases:
            p = tokens(phrase)
            out += [list(range(i, i + len(p))) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        return out


#: Opening words of public licence notices.
TEMPLATES = (
    Template("agpl-3.0", "GNU Affero General Public License", ("Affero General Public License",)),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("Apache License, Version 2.0",)),
    Template(
        "bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met", ("Redistribution and use in source and binary forms",),
    ),
    Template("cc-by-4.0", "Licensed under CC BY 4.0", ("CC BY 4.0",)),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("CC BY-NC 4.0",)),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ("CC BY-SA 4.0",)),
    Template("gpl-2.0", "licensed under the GNU General Public License, version 2", ("General Public License, version 2",)),
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3", ("General Public License, version 3",)),
    Template("isc", "Permission to use, copy, modify, and or distribute this software for any purpose with or without fee is hereby granted",
             ("Permission to use, copy, modify",)),
    Template("lgpl", "GNU Lesser General Public License", ("Lesser General Public License",)),
    Template("mit-license", "Released under the MIT License", ("the MIT License",)),
    Template(
        "mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files", ("Permission is hereby granted, free of charge",),
    ),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("Mozilla Public License",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)

VOCABULARY = sorted({w for t in TEMPLATES for w in t.words} | {w for p in BASE.values() for w in p})


def _words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    d = docs.select(F.col(id_col).alias("id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    return with_column_once(d, "w", F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).select("id", "w")


def document_frequencies(docs: DataFrame, text_col: str = "text") -> dict[str, int]:
    """Documents that hold each licence word, and all documents (under ""): one row
    a word of the fixed vocabulary."""
    d = _words(docs.select(F.lit(0).alias("id"), F.col(text_col).alias("text")), "id", "text")
    seen = F.array_intersect("w", F.array(*map(F.lit, VOCABULARY)))
    counts = d.select(F.explode(F.array_append(seen, "")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return {r["word"]: r["n"] for r in counts.collect()}


def anchors(frequency: dict[str, int]) -> list[tuple[str, int, int]]:
    """The index: (word, template, position) of every template's rare words and of
    each key phrase's VOTES rarest, of those that the corpus holds. Ascending
    document frequency is descending IDF."""
    out = []
    most = RARE_SHARE * frequency.get("", 0)
    for k, t in enumerate(TEMPLATES):
        order = sorted((w for w in set(t.words) if w in frequency), key=lambda w: (frequency[w], w))
        rare = {w for n, w in enumerate(order) if n < ANCHORS or frequency[w] <= most}
        for place in t.places:
            inside = {t.words[i] for i in place}
            rare.update([w for w in order if w in inside][:VOTES])
        out += [(w, k, i) for i, w in enumerate(t.words) if w in rare]
    return out


def _base_places(w: Column) -> Column:
    """array<struct<start, label>> of the base phrases, found from their last word."""
    spots = F.filter(F.transform(w, lambda x, i: F.when(x == LAST, i)), lambda i: i.isNotNull())
    one = [F.transform(_ending(w, spots, phrase), _start_of(label, len(phrase))) for label, phrase in BASE.items()]
    return F.concat(*one)


def _preceded(w: Column, i: Column, phrase: tuple[str, ...]) -> Column:
    ok = F.lit(True)
    for back, word in enumerate(reversed(phrase[:-1]), start=1):
        ok = ok & F.coalesce(F.get(w, i - back) == word, F.lit(False))
    return ok


def _ending(w: Column, spots: Column, phrase: tuple[str, ...]) -> Column:
    return F.filter(spots, lambda i: _preceded(w, i, phrase))


def _start_of(label: str, n: int) -> Callable[[Column], Column]:
    return lambda i: F.struct((i - (n - 1)).cast("long").alias("start"), F.lit(label).alias("label"))


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, base (array of start, label), found (array of label,
    start, score), sorted."""
    index = anchors(document_frequencies(docs, text_col))
    of_word: dict[str, list[Column]] = {}
    for word, t, i in index:
        of_word.setdefault(word, []).append(F.struct(F.lit(t).alias("t"), F.lit(i).alias("i")))
    of_word = of_word or {"": [F.struct(F.lit(0).alias("t"), F.lit(0).alias("i"))]}  # no licence word anywhere
    posting = F.create_map(*[x for word, spots in sorted(of_word.items()) for x in (F.lit(word), F.array(*spots))])
    looked_up = sorted(of_word)

    d = _words(docs, id_col, text_col)
    asked = F.array(*map(F.lit, sorted({*looked_up, LAST})))
    d = with_column_once(d, "near", F.arrays_overlap("w", asked))
    none = "array<struct<t: int, at: int>>"
    hits = F.filter(F.transform("w", lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: s.x.isin(looked_up))
    votes = F.flatten(F.transform(hits, lambda s: F.transform(F.element_at(posting, s.x), lambda p: F.struct(p.t.alias("t"), (s.i - p.i).alias("at")))))
    d = with_column_once(d, "votes", F.when(F.col("near"), F.sort_array(votes).cast(none)).otherwise(F.array().cast(none)))
    # In sorted votes, a start with enough of them equals the one VOTES - 1 places before.
    enough = F.filter("votes", lambda v, i: F.coalesce(F.get("votes", i - (VOTES - 1)) == v, F.lit(False)))
    d = with_column_once(d, "starts", F.array_distinct(enough))
    words_of = F.array(*[F.array(*map(F.lit, t.words)) for t in TEMPLATES])
    phrases_of = F.array(*[F.array(*[F.array(*map(F.lit, p)) for p in t.places]) for t in TEMPLATES])
    labels = F.array(*[F.lit(t.label) for t in TEMPLATES])
    w = F.col("w")
    in_place = lambda s, j: F.coalesce(F.get(w, s.at + j) == F.get(F.get(words_of, s.t), j), F.lit(False))
    verified = F.filter("starts", lambda s: F.exists(F.get(phrases_of, s.t), lambda p: F.forall(p, lambda j: in_place(s, j))))
    share = lambda s: F.size(F.filter(F.sequence(F.lit(0), F.size(F.get(words_of, s.t)) - 1), lambda j: in_place(s, j))) / F.size(F.get(words_of, s.t))
    found = F.transform(verified, lambda s: F.struct(F.get(labels, s.t).alias("label"), s.at.cast("long").alias("start"), share(s).alias("score")))
    empty_found = F.array().cast("array<struct<label: string, start: long, score: double>>")
    empty_base = F.array().cast("array<struct<start: long, label: string>>")
    return d.select(
        "id",
        F.size("w").cast("long").alias("n_words"),
        F.when(F.col("near"), F.sort_array(_base_places(w))).otherwise(empty_base).alias("base"),
        F.when(F.size("starts") > 0, F.sort_array(found)).otherwise(empty_found).alias("found"),
    )
