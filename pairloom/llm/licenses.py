"""License scan by ordered signature rules.

A text is reduced to its words in small letters.  Every rule is a regular
expression over these words with keywords that each match must contain: whole
words, or beginnings of words that end in a hyphen here.  One pass over the text
finds the keywords in it, and only rules whose keywords all stand there are
tried.  Detections are then put in the order of
their places, the wider first, and one that lies inside the one kept before
stays only if its rule has a higher priority.

Some phrases are required for certain (``BASE``): their places are all reported,
and their labels always stay.

The rules are made from templates for every license and name, and from
sentences of license texts.  All is DataFrame functions.

Defined results: a null text counts as empty.  A text without words has no
places, empty labels and score 0.  Rows are taken one by one, so repeated rows
give repeated results.
"""

from __future__ import annotations

import functools
import json
import re

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.llm.spans import let, running, spans

#: What separates words, and phrases with their labels.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Label, words of the short identifier, names as expressions over words (they begin with a keyword).
LICENSES = (
    ("mit", "mit", ("mit licen[sc]e", "mit x11 licen[sc]e", "expat licen[sc]e")),
    ("mit-0", "mit 0", ("mit no attribution",)),
    ("apache-1", "apache 1 1", ("apache software licen[sc]e version 1(?: [01])?", "apache licen[sc]e 1(?: [01])?")),
    ("apache-2", "apache 2 0", ("apache(?: software)? licen[sc]e(?: version| v)? 2(?: 0)?", "apache 2(?: 0)?")),
    ("bsd-2-clause", "bsd 2 clause", ("bsd 2 clause", "simplified bsd", "freebsd licen[sc]e")),
    ("bsd-3-clause", "bsd 3 clause", ("bsd 3 clause", "new bsd", "modified bsd", "revised bsd")),
    ("bsd-4-clause", "bsd 4 clause", ("bsd 4 clause", "original bsd")),
    ("0bsd", "0bsd", ("zero clause bsd", "bsd zero clause")),
    ("bsd", "bsd", ("bsd licen[sc]e", "bsd style licen[sc]e")),
    ("isc", "isc", ("isc licen[sc]e",)),
    ("gpl-2", "gpl 2 0(?: only| or later)?", ("gnu general public licen[sc]e(?: version| v) ?2(?: 0)?", "gnu gpl(?: version)? v?2", "gpl ?v?2(?: 0)?", "gplv2")),
    ("gpl-3", "gpl 3 0(?: only| or later)?", ("gnu general public licen[sc]e(?: version| v) ?3(?: 0)?", "gnu gpl(?: version)? v?3", "gpl ?v?3(?: 0)?", "gplv3")),
    ("gpl", "gpl", ("gnu general public licen[sc]e", "gnu gpl", "gpl licen[sc]e")),
    ("lgpl-2.1", "lgpl 2 1(?: only| or later)?", ("gnu lesser general public licen[sc]e(?: version| v) ?2 1", "lgpl ?v?2 1", "lgplv2 1")),
    ("lgpl-3", "lgpl 3 0(?: only| or later)?", ("gnu lesser general public licen[sc]e(?: version| v) ?3(?: 0)?", "lgpl ?v?3", "lgplv3")),
    ("lgpl", "lgpl", ("gnu lesser general public licen[sc]e", "gnu library general public licen[sc]e", "lgpl licen[sc]e")),
    ("agpl-3", "agpl 3 0(?: only| or later)?", ("gnu affero general public licen[sc]e(?: version| v) ?3(?: 0)?", "agpl ?v?3", "agplv3")),
    ("agpl", "agpl", ("gnu affero general public licen[sc]e", "affero general public licen[sc]e")),
    ("gfdl", "gfdl 1 3", ("gnu free documentation licen[sc]e", "gfdl")),
    ("mpl-1.1", "mpl 1 1", ("mozilla public licen[sc]e(?: version| v) ?1 1", "mpl 1 1")),
    ("mpl-2", "mpl 2 0", ("mozilla public licen[sc]e(?: version| v)? ?2(?: 0)?", "mpl 2(?: 0)?")),
    ("epl-1", "epl 1 0", ("eclipse public licen[sc]e(?: version| v)? ?1(?: 0)?", "epl 1 0")),
    ("epl-2", "epl 2 0", ("eclipse public licen[sc]e(?: version| v)? ?2(?: 0)?", "epl 2 0")),
    ("cddl", "cddl 1 0", ("common development and distribution licen[sc]e", "cddl")),
    ("cpl", "cpl 1 0", ("common public licen[sc]e",)),
    ("eupl", "eupl 1 2", ("european union public licen[sc]e", "eupl")),
    ("artistic-1", "artistic 1 0", ("artistic licen[sc]e 1(?: 0)?",)),
    ("artistic-2", "artistic 2 0", ("artistic licen[sc]e 2(?: 0)?",)),
    ("zlib", "zlib", ("zlib licen[sc]e", "zlib libpng licen[sc]e")),
    ("bsl-1", "bsl 1 0", ("boost software licen[sc]e",)),
    ("unlicense", "unlicense", ("unlicense",)),
    ("wtfpl", "wtfpl", ("wtfpl", "do what the fuck you want to public licen[sc]e")),
    ("ofl-1.1", "ofl 1 1", ("sil open font licen[sc]e", "open font licen[sc]e")),
    ("psf", "psf 2 0", ("python software foundation licen[sc]e", "psf licen[sc]e")),
    ("postgresql", "postgresql", ("postgresql licen[sc]e",)),
    ("php", "php 3 01", ("php licen[sc]e",)),
    ("openssl", "openssl", ("openssl licen[sc]e",)),
    ("ms-pl", "ms pl", ("microsoft public licen[sc]e",)),
    ("ms-rl", "ms rl", ("microsoft reciprocal licen[sc]e",)),
    ("busl", "busl 1 1", ("business source licen[sc]e",)),
    ("sspl", "sspl 1 0", ("server side public licen[sc]e",)),
    ("odbl", "odbl 1 0", ("open database licen[sc]e", "odbl")),
    ("odc-by", "odc by 1 0", ("open data commons attribution", "odc by")),
    ("pddl", "pddl 1 0", ("public domain dedication and licen[sc]e",)),
    ("cc0", "cc0 1 0", ("cc0", "creative commons zero")),
    ("cc-by-nc-nd", "cc by nc nd [1-4] 0", ("cc by nc nd", "creative commons attribution non ?commercial no ?deriv(?:ative)?s")),
    ("cc-by-nc-sa", "cc by nc sa [1-4] 0", ("cc by nc sa", "creative commons attribution non ?commercial share ?alike")),
    ("cc-by-nc", "cc by nc [1-4] 0", ("cc by nc", "creative commons attribution non ?commercial")),
    ("cc-by-nd", "cc by nd [1-4] 0", ("cc by nd", "creative commons attribution no ?deriv(?:ative)?s")),
    ("cc-by-sa", "cc by sa [1-4] 0", ("cc by sa", "creative commons attribution share ?alike")),
    ("cc-by", "cc by [1-4] 0", ("cc by", "creative commons attribution")),
    ("openrail", "openrail", ("openrail(?: [ms])?", "responsible ai licen[sc]e")),
)

#: Template, confidence in percent, which is the priority, too.
_GRANT = "(?:licen[sc]ed|released|distributed|available|provided|published|covered|dual licen[sc]ed)"
TEMPLATES = (
    ("spdx licen[sc]e identifier {short}", 100),
    (_GRANT + " under (?:the |an? )?(?:terms of (?:the |an? )?)?{name}", 95),
    ("(?:subject to|according to|governed by|terms of) (?:the )?{name}", 85),
    ("(?:see|read) (?:the )?{name}", 65),
    ("licen[sc]e {name}", 75),
    ("{name}", 60),
)

#: Sentences of license texts: label, confidence, keyword, expression.
SENTENCES = (
    ("mit", 90, "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", 80, "copyright", "the above copyright notice and this permission notice shall be included"),
    ("bsd", 90, "redistribution", "redistribution and use in source and binary forms with or without modification"),
    ("bsd-3-clause", 92, "endorse", "may be used to endorse or promote products derived from this software"),
    ("isc", 88, "permission", "permission to use copy modify and or distribute this software for any purpose"),
    ("apache-2", 92, "compliance", "you may not use this file except in compliance with the licen[sc]e"),
    ("gpl", 90, "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e"),
    ("lgpl", 92, "redistribute", "you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[sc]e"),
    ("agpl", 92, "redistribute", "you can redistribute it and or modify it under the terms of the gnu affero general public licen[sc]e"),
    ("unlicense", 92, "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("public-domain", 70, "domain", "(?:dedicated|released|placed) (?:to|into|in) the public domain"),
    ("zlib", 85, "altered", "altered source versions must be plainly marked as such"),
    ("wtfpl", 92, "fuck", "you just do what the fuck you want to"),
    ("mpl-2", 92, "mozilla", "this source code form is subject to the terms of the mozilla public licen[sc]e"),
    ("no-warranty", 50, "warranty", "without (?:any )?warranty(?: of any kind)?"),
    ("all-rights-reserved", 55, "reserved", "all rights reserved"),
    ("proprietary", 70, "proprietary", "proprietary and confidential"),
    ("copyright", 40, "copyright", "copyright(?: c)? (?:19|20)[0-9]{2}"),
)

PLACES = "array<struct<label:string,word:int>>"
DETECTIONS = "array<struct<start:int,end:int,label:string,rule:int,priority:int>>"


def _leading(expression: str) -> str:
    """The word that an expression begins with, or its beginning if the word may go on."""
    word = re.match("[a-z0-9]+", expression)[0]
    return word if re.match(r"$| [^?]|\(\?: ", expression[len(word):]) else word + "-"


def _required(template: str, name: str) -> set[str]:
    """Keywords that stand in each match of a template for a name."""
    found = {_leading(name)}
    if re.search(r"(^| )licen\[sc\]e", template.split("{")[0].replace(_GRANT, "")) or " licen[sc]e" in name:
        found.add("licen-")
    return found


@functools.cache
def rules() -> list[dict]:
    """All rules, the highest priority first."""
    made = []
    for label, short, names in LICENSES:
        for template, priority in TEMPLATES:
            for name in (short,) if "{short}" in template else names:
                made.append((priority, label, _required(template, name), template.format(short=short, name=name)))
    made += [(priority, label, {keyword}, sentence) for label, priority, keyword, sentence in SENTENCES]
    made.sort(key=lambda r: -r[0])
    begins = {k for _, _, needs, _ in made for k in needs if k.endswith("-")}

    def found_as(keyword: str) -> str:
        """A keyword that begins like the beginning of another is found as that one."""
        return min((k for k in begins if keyword.startswith(k[:-1])), key=len, default=keyword)

    return [
        {"rule": i, "priority": p, "label": label, "needs": sorted(set(map(found_as, needs))), "pattern": f" {expression}(?= )"}
        for i, (p, label, needs, expression) in enumerate(made)
    ]


def keywords() -> list[str]:
    return sorted({k for r in rules() for k in r["needs"]})


def _keyword_pattern() -> str:
    """Each keyword as it stands in a text, beginnings first; those that share a first letter are tried together."""
    def any_of(found: list[str]) -> str:
        letters = sorted({k[0] for k in found})
        return "|".join(f"{c}(?:{'|'.join(k[1:] for k in found if k[0] == c)})" for c in letters)

    begins, whole = ([k.rstrip("-") for k in keywords() if k.endswith("-") is kind] for kind in (True, False))
    return f" (?:(?:{any_of(begins)})|(?:{any_of(whole)})(?= ))"


def _groups() -> list[dict]:
    """The rules by the keywords that they need."""
    by: dict[tuple, list[dict]] = {}
    for r in rules():
        by.setdefault(tuple(k.rstrip("-") for k in r["needs"]), []).append({k: v for k, v in r.items() if k != "needs"})
    return [{"needs": list(k), "rules": v} for k, v in by.items()]


def words_column(text: Column) -> Column:
    """A text's words in small letters, each between single blanks.

    ``lower`` also changes letters beyond ASCII.  That moves no word's bounds,
    and of all of them only the Kelvin sign becomes an ASCII letter, k, which
    no base phrase has.
    """
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NO_WORD, " ")), F.lit(" "))


def _base_places(words: Column, phrase: str, label: str) -> Column:
    """``{label, word}`` for each place where the phrase starts; words count from 0."""
    size = len(phrase.split(" "))

    # what stands before each place; the part after the last one has none
    def placed(blanks: Column) -> Column:
        at = running(blanks, F.lit(0), lambda now, n: now + n + size)
        return F.zip_with(blanks, at, lambda n, now: F.struct(F.lit(label).alias("label"), (now + n).alias("word")))

    between = F.split(words, f" {phrase}(?= )", -1)
    places = let(let(between, lambda parts: F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), _blanks)), placed)
    return F.when(F.contains(words, F.lit(f" {phrase} ")), places).otherwise(F.array().cast(PLACES))


def _blanks(text: Column) -> Column:
    """How many blanks a text has: each stands before a word."""
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _detections(words: Column, present: Column) -> Column:
    kind = "array<struct<needs:array<string>,rules:array<struct<rule:int,priority:int,label:string,pattern:string>>>>"
    known = F.from_json(F.lit(json.dumps(_groups())), kind)

    def found(rule: Column) -> Column:
        return F.transform(spans(words, rule["pattern"]), lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), rule["label"].alias("label"), rule["rule"].alias("rule"), rule["priority"].alias("priority")
        ))

    tried = F.filter(known, lambda group: F.forall(group["needs"], lambda k: F.array_contains(present, k)))
    return F.flatten(F.transform(F.flatten(F.transform(tried, lambda group: group["rules"])), found))


def _resolved(found: Column) -> Column:
    """Detections without those that end no further than the ones kept before, unless their priority is above that of the last one kept."""
    def before(x: Column, y: Column) -> Column:
        def by(left, right, then):
            return F.when(left < right, -1).when(left > right, 1).otherwise(then)

        return by(x["start"], y["start"], by(y["end"], x["end"], by(y["priority"], x["priority"], by(x["rule"], y["rule"], F.lit(0)))))

    def step(seen: Column, x: Column) -> Column:
        further = x["end"] > seen["end"]
        return F.struct(
            F.when(further, x["end"]).otherwise(seen["end"]).alias("end"),
            F.when(further | (x["priority"] > seen["priority"]), x["priority"]).otherwise(seen["priority"]).alias("priority"),
        )

    def kept(ordered: Column) -> Column:
        start = F.struct(F.lit(-1).alias("end"), F.lit(-1).alias("priority"))
        each = F.zip_with(ordered, running(ordered, start, step), lambda x, seen: F.struct(
            ((x["end"] > seen["end"]) | (x["priority"] > seen["priority"])).alias("keep"), x.alias("found")
        ))
        return F.transform(F.filter(each, lambda x: x["keep"]), lambda x: x["found"])

    return let(F.array_sort(found, before), lambda ordered: F.when(F.size(ordered) > 0, kept(ordered)).otherwise(F.array().cast(DETECTIONS)))


def scan(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, n_words, base, detections)``.

    ``base`` has ``{label, word}`` for all places of the base phrases;
    ``detections`` what the rules found, with places in the text of words
    between single blanks.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), words_column(F.col(text_col).cast("string")).alias("words"))
    found = F.regexp_extract_all("words", F.lit(_keyword_pattern()), F.lit(0))
    present = F.array_distinct(F.transform(found, lambda k: F.trim(k)))
    rows = rows.select("*", present.alias("present"))
    places = F.flatten(F.array(*[_base_places(F.col("words"), phrase, label) for phrase, label in BASE]))
    detected = F.when(F.size("present") > 0, _resolved(_detections(F.col("words"), F.col("present")))).otherwise(F.array().cast(DETECTIONS))
    # words stand between single blanks; a text without words is two blanks
    n_words = F.when(F.col("words") == "  ", 0).otherwise(_blanks(F.col("words")) - 1).cast("long")
    return rows.select("doc_id", n_words.alias("n_words"), places.alias("base"), detected.alias("detections"))


def summary(scanned: DataFrame) -> DataFrame:
    """Counts, first and last place, labels and score of each scanned row."""
    words = F.transform("base", lambda x: x["word"].cast("long"))
    base = F.transform("base", lambda x: x["label"])
    labels = F.transform("detections", lambda x: x["label"])
    best = F.coalesce(F.array_max(F.transform("detections", lambda x: x["priority"])), F.lit(0)) / 100

    def joined(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(found)), ",")

    return scanned.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, labels)).alias("labels"),
        F.greatest(best, F.when(F.size("base") > 0, 0.95).otherwise(0.0)).alias("score"),
    )
