"""License scans against the same rules applied one by one in Python."""

import re
from itertools import product

from learnertrace.llm import licenses

DOCS = "doc_id long, text string, start int, kept string, `n.words` int"


def brute(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    joined, found = " " + " ".join(words) + " ", []
    gated = any(k in lower.lower() for k in licenses.KEYWORDS)
    for nth, rule in enumerate(licenses.rules() if gated else ()):
        for match in re.finditer(rule["regex"], joined):
            start = joined[:match.start()].count(" ") - 1
            found.append((start, start + match[0].count(" ") + 1, rule["priority"], nth, rule))
    kept = [x for x in found if not any(
        y is not x and y[0] <= x[0] and x[1] <= y[1] and y[2] <= x[2]
        and ((y[0], -y[1], y[2], y[3]) < (x[0], -x[1], x[2], x[3])) for y in found)]
    base = [x for x in found if x[4]["base"]]
    labels = {x[4]["label"] for x in kept + base}
    return (len(words), len(base), min((x[0] for x in base), default=None),
            max((x[0] for x in base), default=None), ",".join(sorted({x[4]["label"] for x in base})),
            ",".join(sorted(labels)), max((x[4]["confidence"] for x in kept + base), default=0.0))


TEXTS = [
    None, "", "...", "no mention at all", "Released under the MIT License.", "mit-license MIT, licensE é",
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.",
    "Licensed under the Apache License, Version 2.0 (the License); Apache license; apache_license",
    "SPDX-License-Identifier: GPL-3.0 or later. Copyright (c) 2020 me, all rights reserved",
    "mit license " * 3000 + "gnu lesser general public license v2.1 or bsd 3-clause license, public domain",
    "mitlicense mit licenses permit license MİT license Mit License", "éGPL license gpl",
    "Lizenz: general   public\nlicense\tGENERAL PUBLIC LICENSE", "the 2 clause bsd license\x00x\x7fmit license",
]


def test_equal_to_rules_one_by_one(spark):
    rows = [(k, t, 0, "x", 1) for k, t in enumerate(TEXTS)] + [(None, TEXTS[4], 0, "x", 1)] * 2
    got = licenses.license_summary(spark.createDataFrame(rows, DOCS)).collect()
    want = sorted((str(r[0]), brute(r[1])) for r in rows)
    assert sorted((str(r.doc_id), (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels,
                                   r.score)) for r in got) == want
    assert licenses.license_summary(spark.createDataFrame([], DOCS)).count() == 0


def test_rules_are_sound():
    every = licenses.rules()
    assert len(every) > 300
    for rule in every:
        assert re.compile(rule["regex"]).groups == 0


def test_labels_of_plain_mentions(spark):
    frame = spark.createDataFrame([(k, t, 0, "x", 1) for k, t in enumerate(TEXTS)], DOCS)
    labels = {r.doc_id: r.labels for r in licenses.license_summary(frame).collect()}
    assert labels[4] == "mit" and labels[6] == "gpl,gpl-3" and labels[7] == "cc-by-nc-4.0"
    assert labels[8] == "apache,apache-2.0" and "lgpl-2.1" in labels[10] and "bsd-3-clause" in labels[10]


def ungated(text):
    """Labels of a text by all rules, whatever words it has."""
    joined = f" {' '.join(re.findall('[^\x00-\x2F\x3A-\x60\x7B-\x7F]+', text.lower()))} "
    found = [(m.start(), m.end(), rule["priority"], nth, rule) for nth, rule in enumerate(licenses.rules())
             for m in re.finditer(rule["regex"], joined)]
    kept = [x for x in found if x[4]["base"] or not any(
        y[0] <= x[0] and x[1] <= y[1] and y[2] <= x[2]
        and (y[0], -y[1], y[2], y[3]) < (x[0], -x[1], x[2], x[3]) for y in found)]
    return ",".join(sorted({x[4]["label"] for x in kept}))


def mentions(expression):
    """Every text that an expression of groups of alternatives, [ ] and ? matches."""
    def sequence(parts):
        return ["".join(x) for x in product(*map(part, parts))]

    def part(node):
        kind, value = str(node[0]), node[1]
        if kind == "LITERAL":
            return [chr(value)]
        if kind == "IN":
            return [x for item in value for x in part(item)]
        if kind == "RANGE":
            return [chr(value[0]), chr(value[1])]
        if kind == "BRANCH":
            return [x for branch in value[1] for x in sequence(branch)]
        if kind == "SUBPATTERN":
            return sequence(value[3])
        assert kind == "MAX_REPEAT" and value[:2] == (0, 1)
        return ["", *sequence(value[2])]

    return sequence(re._parser.parse(expression.removeprefix("(?<= )").removesuffix("(?= )")))


def test_keywords_are_in_every_match():
    for rule in licenses.rules():
        for text in mentions(rule["regex"]):
            assert re.search(rule["regex"], f" {text} ")
            assert rule["keyword"] in text and any(sign in text for sign in rule["signs"])
            assert any(keyword in text for keyword in licenses.KEYWORDS)


def test_no_gate_hides_a_match(spark):
    texts = ["released under the MIT", "Distributed under the BSD.", "provided under Apache 2.0", "CC BY version 4.0",
             "Redistribution and use in source and binary forms", "PERMISSION to use, copy, modify, and/or distribute "
             "this software", "available under the Creative Commons Attribution-Share Alike 4.0",
             "Creative Commons Attribution Non Commercial version 3.0", "licensed under the Open Font License 1.1"]
    for rule in licenses.rules():
        every = sorted(mentions(rule["regex"]))
        texts += [every[0], every[-1], every[len(every) // 2], f"x {every[len(every) // 3]}, y"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.license_summary(frame).collect()}
    assert got == {k: ungated(text) for k, text in enumerate(texts)}
    assert all(got.values())
    assert [got[k] for k in range(7)] == ["mit", "bsd", "apache-2.0", "cc-by-4.0", "bsd", "isc", "cc-by-sa-4.0"]
