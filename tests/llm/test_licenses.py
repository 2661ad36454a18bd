import re
import time

import pyarrow.parquet as pq

from pairloom.llm import licenses, queries


def brute(text):
    """The contract and the method, word by word."""
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    base = []
    for phrase, label in licenses.BASE:
        p = phrase.split()
        base += [(label, i) for i in range(len(words)) if words[i : i + len(p)] == p]
    line = " " + " ".join(words) + " "
    found = [
        (m.start(), -m.end(), -r["priority"], r["rule"], r["label"])
        for r in licenses.rules() for m in re.finditer(r["pattern"], line.lower())
    ]
    end, priority, kept = -1, -1, []
    for start, e, p, _, label in sorted(found):
        if -e > end or -p > priority:
            kept.append((label, -p))
            priority = -p
            end = max(end, -e)
    places = [i for _, i in base]
    return (
        len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted({label for label, _ in base})),
        ",".join(sorted({label for label, _ in base + kept})), max([p / 100 for _, p in kept] + [0.95] * bool(base) + [0.0]),
    )


def columns(r):
    return (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"])


def test_query_against_brute_force(spark, sf):
    got = {r["doc_id"]: columns(r) for r in queries.QUERIES["op2_license_scan"](spark, sf).collect()}
    docs = pq.read_table(f"{sf}/documents.parquet").to_pandas()
    want = {i: brute(t) for i, t in zip(docs.doc_id, docs.text, strict=True)}
    assert got == want and sum(bool(v[5]) for v in want.values()) > 4


TEXTS = [
    None, "", "... !", "Under the MIT License under the mit license", "x Apache License, Version 2.0 and CC BY-NC-SA 4.0",
    "Licensed under the GNU General Public License, version 3", "SPDX-License-Identifier: Apache-2.0", "CC BY NC CC BY NC",
    "Released under the terms of the Mozilla Public License 2.0. All rights reserved.", "Copyright (c) 2020", "no attribution",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "the mİt licKense under the É mit license",
    "under the mit license " * 3000, "license " * 40_000, "BSD 3-Clause; new BSD; GPLv2 or LGPL v3, Boost Software License; see the ISC license",
]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, "c", 0) for i, t in enumerate(TEXTS)] + [(None, "cc by nc", "c", 0)], "doc_id long, text string, words string, base int")
    got = {r["doc_id"]: columns(r) for r in licenses.summary(licenses.scan(docs)).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)} | {None: brute("cc by nc")}
    assert licenses.summary(licenses.scan(docs.limit(0))).count() == 0


def test_every_rule_is_reached():
    """Each rule's keywords stand, at the start of a word, in whatever it matches."""
    assert len(licenses.rules()) > 300
    for r in licenses.rules():
        tail = r["pattern"].removesuffix("(?= )")
        while (shorter := re.sub(r"\(\?:[^()]*\)\?", "", tail)) != tail:
            tail = shorter
        # what is left must be there; alternatives in brackets are not, one by one
        tail = re.sub(r"\(\?:[^()]*\)", "", tail)
        assert r["needs"] and all(re.search(rf" {k[:-1]}" if k.endswith("-") else rf" {k}( |$)", tail) for k in r["needs"]), r
    begins = [k[:-1] for k in licenses.keywords() if k.endswith("-")]
    assert not any(a != b and a.startswith(b) for a in begins + licenses.keywords() for b in begins if a != b + "-")


def test_native_plan(spark, sf):
    plan = queries.QUERIES["op2_license_scan"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Join", "Exchange"))


def test_time_grows_with_the_matches(spark):
    """A text of 40,000 base phrases and as many detections is scanned in time that grows with their number."""
    def seconds(n):
        text = "under the MIT license, " * n
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.time()
        (row,) = licenses.summary(licenses.scan(docs)).collect()
        assert row["n_base"] == n and row["last_word"] == 4 * (n - 1) and "mit" in row["labels"]
        return time.time() - start

    seconds(100)
    few, many = seconds(20_000), seconds(40_000)
    assert many < 2.5 * few + 2, (few, many)
