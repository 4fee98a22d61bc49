"""Licences by ordered signature rules.

A text becomes its words, joined by single spaces. Rules are regular expressions over that form, each behind a
keyword that the text must contain. Every place where a rule fits is a detection, an interval of words;
a detection inside one of a rule that comes earlier in the order is suppressed. Only built-in column
functions run, row by row: there is no shuffle.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaphist.llm.license_texts import TEXTS
from snaphist.llm.store import ascii_lower

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Licences: label, keyword, how the name is written, versions.
FAMILIES = [
    ("agpl", "affero", r"(gnu )?affero general public licen[cs]e", ("1 0", "3 0")),
    ("lgpl", "lesser general", r"(gnu )?lesser general public licen[cs]e", ("2 1", "3 0")),
    ("gpl", "general public", r"(gnu )?general public licen[cs]e", ("1 0", "2 0", "3 0")),
    ("gfdl", "free documentation", r"(gnu )?free documentation licen[cs]e", ("1 1", "1 2", "1 3")),
    ("apache", "apache", r"apache( software)? licen[cs]e", ("1 0", "1 1", "2 0")),
    ("mpl", "mozilla", r"mozilla public licen[cs]e", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse", r"eclipse public licen[cs]e", ("1 0", "2 0")),
    ("eupl", "european union", r"european union public licen[cs]e", ("1 1", "1 2")),
    ("cddl", "development and distribution", r"common development and distribution licen[cs]e", ("1 0", "1 1")),
    ("cpl", "common public", r"common public licen[cs]e", ("1 0",)),
    ("osl", "open software", r"open software licen[cs]e", ("2 1", "3 0")),
    ("afl", "academic free", r"academic free licen[cs]e", ("2 1", "3 0")),
    ("artistic", "artistic", r"artistic licen[cs]e", ("1 0", "2 0")),
    ("bsl", "boost", r"boost software licen[cs]e", ("1 0",)),
    ("zlib", "zlib", r"zlib( libpng)? licen[cs]e", ()),
    ("isc", "isc", r"isc licen[cs]e", ()),
    ("mit", "mit", r"mit( x11)? licen[cs]e", ()),
    ("mit-0", "mit no attribution", r"mit no attribution licen[cs]e", ()),
    ("bsd", "bsd", r"((two|three|four|2|3|4) clause )?bsd( (two|three|four|2|3|4) clause)? licen[cs]e", ()),
    ("unlicense", "unlicense", r"unlicense", ()),
    ("wtfpl", "do what the", r"do what the \w+ you want to public licen[cs]e", ("2",)),
    ("cc0", "cc0", r"cc0", ("1 0",)),
    ("cc-by-nc-nd", "by nc nd", r"(creative commons )?cc by nc nd", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", "by nc sa", r"(creative commons )?cc by nc sa", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "by nc", r"(creative commons )?cc by nc", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "by nd", r"(creative commons )?cc by nd", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "by sa", r"(creative commons )?cc by sa", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by", "cc by", r"(creative commons )?cc by", ("2 0", "2 5", "3 0", "4 0")),
    ("creative-commons", "creative commons", r"creative commons( attribution)? licen[cs]e", ()),
    ("ofl", "open font", r"(sil )?open font licen[cs]e", ("1 0", "1 1")),
    ("odbl", "open data", r"open (data commons )?database licen[cs]e", ("1 0",)),
    ("python", "python software", r"python software foundation licen[cs]e", ("2 0",)),
    ("postgresql", "postgresql", r"postgresql licen[cs]e", ()),
    ("php", "php", r"php licen[cs]e", ("3 0", "3 01")),
    ("ruby", "ruby", r"ruby licen[cs]e", ()),
    ("openssl", "openssl", r"openssl licen[cs]e", ()),
    ("public-domain", "public domain", r"public domain( dedication)?", ()),
]

# SPDX identifiers and short names by label, the longer before those they begin with; a few are clear by themselves.
SHORT = {
    "agpl": r"(gnu )?agpl", "lgpl": r"(gnu )?lgpl", "gpl": r"(gnu )?gpl", "gfdl": r"(gnu )?gfdl", "apache": "apache",
    "mpl": "mpl", "epl": "epl", "eupl": "eupl", "cddl": "cddl", "cpl": "cpl", "osl": "osl", "afl": "afl",
    "artistic": "artistic", "bsl": "bsl", "zlib": "zlib", "isc": "isc", "mit-0": "mit 0", "mit": "mit",
    "bsd": r"bsd( (0|1|2|3|4|two|three|four) clause)?", "unlicense": "unlicense", "wtfpl": "wtfpl", "cc0": "cc0",
    "cc-by-nc-nd": "cc by nc nd", "cc-by-nc-sa": "cc by nc sa", "cc-by-nc": "cc by nc", "cc-by-nd": "cc by nd",
    "cc-by-sa": "cc by sa", "cc-by": "cc by", "ofl": "ofl", "odbl": "odbl", "python": "psf",
    "postgresql": "postgresql", "php": "php", "ruby": "ruby", "openssl": "openssl",
}
CLEAR = ("agpl", "lgpl", "gpl", "gfdl", "eupl", "cddl", "wtfpl", "odbl")
SPDX = "spdx license identifier {}"
# Stems that many licence texts share and other texts seldom hold.
STEMS = ("permission", "redistribut", "copyright", "warrant", "public domain", "software")
# What stands before a short name in every form but the bare one.
_LEAD = r"(under|of|the|identifier) "

# Ways to grant a licence, from the longest to the bare name; {} is the name.
FORMS = [
    r"(this|the) \w+ is (licensed|released|distributed|available|published) under( the)?( terms of)?( the)? {}",
    r"(licensed|released|distributed|available|published) under( the)?( terms of)?( the)? {}",
    r"(subject to|under) the terms( and conditions)? of the {}",
    SPDX,
    r"{}",
]


@dataclass(frozen=True)
class Rule:
    """A detection of ``label`` wherever ``pattern`` fits whole words of a text with ``keyword``.

    ``probe`` is an expression that fits wherever ``pattern`` does; rules may share it.
    """

    label: str
    keyword: str
    pattern: str
    probe: str = ""

    def anchor(self) -> str:
        """What any text that the rule fits contains, as rare as possible and shared by many rules."""
        sure = self.pattern
        while "(" in sure:
            inner = re.sub(r"\([^()]*\)\??(\{\d+,\d+\})?", "", sure)
            sure = inner if inner != sure else ""
        if "licen[cs]e" in self.pattern or re.search(r"(^| )license\b", self.pattern):
            return "licen"
        if "|" in sure:
            return self.keyword
        return next((stem for stem in STEMS if re.search(rf"(^| ){stem}", sure)), self.keyword)


def rules() -> list[Rule]:
    """All rules, the first ones deciding over those after them.

    Longer forms come before shorter, named versions before none, and families in the order given.
    """
    made = []
    number_of = {label: versions for label, _, _, versions in FAMILIES}
    for form in FORMS:
        if form != SPDX:
            made += _named(form)
        for label, name in [*SHORT.items(), ("python", "python")]:
            if form == "{}" and label not in CLEAR:
                continue
            probe = name if form == "{}" else _LEAD + name
            keyword = name if label == "python" else label.split("-")[0]
            tail = "( only| or later)?"
            for v in number_of[label]:
                number = v.removesuffix(" 0")
                made.append(Rule(f"{label}-{v.replace(' ', '.')}", keyword, form.format(name) + rf"( (version|v))? ?v?{number}( 0)?{tail}", probe))
            made.append(Rule(label, keyword, form.format(name) + tail, probe))
    return [Rule(*t) for t in TEXTS] + made


def _named(form: str) -> list[Rule]:
    """Rules of one form with the full names."""
    made = []
    for label, keyword, name, versions in FAMILIES:
        for v in versions:
            number = v.removesuffix(" 0") if v.endswith(" 0") else v
            tail = rf"( (version|v))? v?{number}( 0)?"
            made.append(Rule(f"{label}-{v.replace(' ', '.')}", keyword, form.format(name) + tail, name))
    return made + [Rule(label, keyword, form.format(name), name) for label, keyword, name, _ in FAMILIES]


def normal_words(text: Column) -> Column:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, each after one space."""
    cut = F.regexp_replace(ascii_lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.concat(F.lit(" "), F.trim(cut))


def _spaces(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it occurs there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _chunks(values: Column) -> Column:
    """An array in pieces of about the square root of its size, so that work on pairs within a piece and on
    the pieces stays far below the square of the size."""
    size = F.size(values)
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(size)).cast("int"))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), size - 1), width)
    return F.transform(starts, lambda i: F.slice(values, i + 1, width))


def _placed(steps: Column) -> Column:
    """Intervals of hits from how many words each has and how many come between it and the one before."""
    spans = "array<struct<start:int,stop:int>>"

    def sums(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda n, x: n + x.b + x.h))
        return F.aggregate(
            totals, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n))
        )

    def within(chunk: Column, begin: Column) -> Column:
        return F.aggregate(
            chunk,
            F.struct(begin.alias("n"), F.array().cast(spans).alias("out")),
            lambda acc, x: F.struct(
                (acc.n + x.b + x.h).alias("n"),
                F.concat(
                    acc.out,
                    F.array(F.struct((acc.n + x.b).alias("start"), (acc.n + x.b + x.h).alias("stop"))),
                ).alias("out"),
            ),
            lambda acc: acc.out,
        )

    return _let(
        _chunks(steps),
        lambda chunks: F.flatten(F.zip_with(chunks, F.slice(sums(chunks), 1, F.size(chunks)), within)),
    )


def places(words: Column, pattern: Column) -> Column:
    """Intervals of words, end exclusive, at which ``pattern``, which begins with a space, fits."""

    def steps(hits: Column) -> Column:
        before = F.slice(F.split(words, pattern, -1), F.lit(1), F.size(hits))
        return F.zip_with(before, hits, lambda b, h: F.struct(_spaces(b).alias("b"), _spaces(h).alias("h")))

    return _let(F.regexp_extract_all(words, pattern, F.lit(0)), lambda hits: _let(steps(hits), _placed))


def _unsuppressed(found: Column) -> Column:
    """Detections that lie in none of an earlier rule, nor at the same place as one.

    In order of their starts, a piece of the detections is compared with those only that reach into its words.
    """
    ordered = F.array_sort(
        F.transform(
            found,
            lambda d: F.struct(
                d.start.alias("start"), d.stop.alias("stop"), d["rank"].alias("rank"), d.label.alias("label")
            ),
        )
    )

    def piece(every: Column, chunk: Column) -> Column:
        first, last = F.get(chunk, F.lit(0)).start, F.get(chunk, F.size(chunk) - 1).start
        near = F.filter(every, lambda e: (e.start <= last) & (e.stop > first))
        return _let(
            near,
            lambda known: F.filter(
                chunk,
                lambda d: ~F.exists(
                    known, lambda e: (e["rank"] < d["rank"]) & (e.start <= d.start) & (e.stop >= d.stop)
                ),
            ),
        )

    kept = _let(ordered, lambda every: F.flatten(F.transform(_chunks(every), lambda chunk: piece(every, chunk))))
    by_rule = F.transform(
        kept,
        lambda d: F.struct(
            d["rank"].alias("rank"), d.start.alias("start"), d.stop.alias("stop"), d.label.alias("label")
        ),
    )
    return F.array_sort(by_rule)


def _pattern(inner: str) -> str:
    return f" (?:{inner})(?= |\\z)"


_RULES = "array<struct<keyword:string,probe:string,rules:array<struct<rank:int,label:string,pattern:string>>>>"


def _rule_table(made: list[Rule]) -> Column:
    """Rules by what gates them: (keyword, probe, rules (rank, label, pattern)), one literal to Spark's planner."""
    gated: dict[tuple[str, str], list[dict]] = {}
    for i, r in enumerate(made):
        rule = {"rank": i, "label": r.label, "pattern": _pattern(r.pattern)}
        gated.setdefault((r.keyword, r.probe), []).append(rule)
    rows = [
        {"keyword": f" {keyword}", "probe": f" (?:{probe})", "rules": listed} for (keyword, probe), listed in gated.items()
    ]
    return F.from_json(F.lit(json.dumps(rows)), _RULES)


def detect(docs: DataFrame, made: list[Rule] | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections).

    The base are the places of ``PHRASES``: how many, where the first and last begin, and their labels.
    ``detections`` (label, start, stop) are those of the rules that no earlier rule suppresses; ``labels`` joins their
    labels and the base's, distinct and sorted. ``score`` is the share of words inside detections or base
    places, 0 without words. Null or empty text has no words. A null doc_id is kept; repeated rows are judged
    each. Other columns, whatever their names, are ignored. An empty table gives no rows.
    """
    made = rules() if made is None else made
    # Most names include the word itself, and keywords such as a common word are tried after it only.
    stems = sorted({r.anchor() for r in made} | {Rule(label, p, p).anchor() for p, label in PHRASES.items()})
    stems = [k for k in stems if not any(o != k and f" {k}".startswith(f" {o}") for o in stems)]
    words = F.col("_words")
    gate = F.lit(False)
    for stem in stems:
        gate = gate | F.contains(words, F.lit(f" {stem}"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normal_words(F.col("text")).alias("_words"))
    rows = rows.select("doc_id", F.when(words == " ", "").otherwise(words).alias("_words"))
    rows = rows.select("doc_id", "_words", gate.alias("_gate"))
    none = F.array().cast("array<struct<label:string,start:int,stop:int>>")

    def base_of(phrase: str, label: str) -> Column:
        found = places(words, F.lit(_pattern(phrase)))
        named = F.transform(
            found, lambda x: F.struct(F.lit(label).alias("label"), x.start.alias("start"), x.stop.alias("stop"))
        )
        return F.when(F.contains(words, F.lit(f" {phrase}")), named).otherwise(none)

    base = F.concat(*[base_of(p, label) for p, label in PHRASES.items()])
    gated = F.filter(
        _rule_table(made),
        lambda g: F.contains(words, g.keyword) & F.regexp_like(words, g.probe),
    )
    found = F.flatten(
        F.transform(
            F.flatten(F.transform(gated, lambda g: g.rules)),
            lambda r: F.transform(
                places(words, r.pattern),
                lambda x: F.struct(
                    r["rank"].alias("rank"), r.label.alias("label"),
                    x.start.alias("start"), x.stop.alias("stop"),
                ),
            ),
        )
    )
    ranked = "array<struct<rank:int,label:string,start:int,stop:int>>"
    rows = rows.select(
        "doc_id",
        F.col("_words"),
        _spaces(words).cast("long").alias("n_words"),
        F.when(F.col("_gate"), base).otherwise(none).alias("_base"),
        F.when(F.col("_gate"), found).otherwise(F.array().cast(ranked)).alias("_found"),
    )
    rows = rows.select(
        "doc_id", "n_words", "_base",
        F.transform(
            _unsuppressed(F.col("_found")),
            lambda d: F.struct(d.label.alias("label"), d.start.alias("start"), d.stop.alias("stop")),
        ).alias("detections"),
    )
    starts = F.transform("_base", lambda b: b.start.cast("long"))
    base_labels = F.array_sort(F.array_distinct(F.transform("_base", lambda b: b.label)))
    labels = F.array_sort(
        F.array_distinct(F.concat(base_labels, F.transform("detections", lambda d: d.label)))
    )
    every = F.array_sort(
        F.transform(F.concat("_base", "detections"), lambda d: F.struct(d.start.alias("start"), d.stop.alias("stop")))
    )
    covered = F.aggregate(
        every,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, d: F.struct(
            (acc.n + F.greatest(F.lit(0), d.stop - F.greatest(acc.end, d.start))).alias("n"),
            F.greatest(acc.end, d.stop).alias("end"),
        ),
        lambda acc: acc.n,
    )
    return rows.select(
        "doc_id",
        "n_words",
        F.size("_base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_words") == 0, 0.0).otherwise(covered / F.col("n_words")).alias("score"),
        "detections",
    )
