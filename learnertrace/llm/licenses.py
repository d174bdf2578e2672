"""License scans by ordered signature rules.

Some hundreds of rules, each a regular expression over the words of a text, are written down
as families of licenses times forms of mention: an identifier tag, a notice ("released under
the ... license, version ..."), a name with a version, a bare name. A rule has a keyword, which
every match contains, and signs, of which every match contains one. A text without any sign of
any rule is not scanned. In the others a rule is tried only where its keyword and a sign stand,
and where two detections overlap so that one lies within the other, the inner one goes unless
its rule has priority. Only DataFrame functions are used.

The text is scanned as its words, lower-cased and joined by one space, with a space at either
end; a detection is an interval of words.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnertrace.llm.common import lower_ascii, table

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Phrases that are always reported, with their labels.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

#: label, keyword (in every match of the name), name as a regular expression over words, versions.
FAMILIES = [
    ("mit", "mit", "mit", []),
    ("mit-expat", "expat", "expat", []),
    ("mit-x11", "x11", "x11", []),
    ("apache", "apache", "apache(?: software)?", ["1 0", "1 1", "2 0"]),
    ("lgpl", "lgpl", "lgpl", ["2 0", "2 1", "3 0", "2", "3"]),
    ("lgpl", "lesser", "(?:gnu )?lesser general public", ["2 1", "3 0", "3"]),
    ("lgpl", "library", "(?:gnu )?library general public", ["2 0", "2"]),
    ("agpl", "agpl", "agpl", ["3 0", "3"]),
    ("agpl", "affero", "(?:gnu )?affero general public", ["3 0", "3"]),
    ("gpl", "gpl", "(?:gnu )?gpl", ["1 0", "2 0", "3 0", "1", "2", "3"]),
    ("gpl", "general", "(?:gnu )?general public", ["1 0", "2 0", "3 0", "1", "2", "3"]),
    ("gfdl", "documentation", "(?:gnu )?free documentation", ["1 1", "1 2", "1 3"]),
    ("mpl", "mozilla", "mozilla public", ["1 0", "1 1", "2 0"]),
    ("mpl", "mpl", "mpl", ["1 0", "1 1", "2 0"]),
    ("epl", "eclipse", "eclipse public", ["1 0", "2 0"]),
    ("cddl", "distribution", "common development and distribution", ["1 0", "1 1"]),
    ("cpl", "common", "common public", ["1 0"]),
    ("eupl", "european", "european union public", ["1 0", "1 1", "1 2"]),
    ("bsd", "bsd", "bsd", []),
    ("bsd-2-clause", "bsd", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", []),
    ("bsd-3-clause", "bsd", "(?:bsd 3 clause|3 clause bsd|new bsd|revised bsd|modified bsd)", []),
    ("bsd-4-clause", "bsd", "(?:bsd 4 clause|4 clause bsd|original bsd)", []),
    ("0bsd", "bsd", "(?:0bsd|zero clause bsd)", []),
    ("isc", "isc", "isc", []),
    ("zlib", "zlib", "zlib", []),
    ("bsl", "boost", "boost software", ["1 0"]),
    ("artistic", "artistic", "artistic", ["1 0", "2 0"]),
    ("unlicense", "unlicense", "unlicense", []),
    ("wtfpl", "wtfpl", "wtfpl", []),
    ("ofl", "font", "(?:sil )?open font", ["1 0", "1 1"]),
    ("python", "python", "python(?: software foundation)?", ["2 0", "2"]),
    ("postgresql", "postgresql", "postgresql", []),
    ("openssl", "openssl", "openssl", []),
    ("php", "php", "php", ["3 0", "3 01"]),
    ("ruby", "ruby", "ruby", []),
    ("ms-pl", "microsoft", "microsoft public", []),
    ("ms-rl", "microsoft", "microsoft reciprocal", []),
    ("odbl", "database", "open database", ["1 0"]),
    ("odc-by", "attribution", "open data commons attribution", ["1 0"]),
    ("cc-by", "cc", "cc by", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-sa", "sa", "cc by sa", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc", "nc", "cc by nc", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nd", "nd", "cc by nd", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc-sa", "nc", "cc by nc sa", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc-nd", "nc", "cc by nc nd", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by", "creative", "creative commons attribution", ["2 0", "3 0", "4 0"]),
    ("cc-by-sa", "share", "creative commons attribution share ?alike", ["2 0", "3 0", "4 0"]),
    ("cc-by-nc", "commercial", "creative commons attribution non ?commercial", ["2 0", "3 0", "4 0"]),
    ("cc0", "cc0", "cc0", ["1 0"]),
]

#: Forms of mention: priority (1 first), confidence, the expression around a name and a version.
TAG, NOTICE, VERSION, NAME = (1, 1.0), (2, 0.9), (3, 0.8), (4, 0.6)
GIVEN = ("released", "distributed", "published", "provided", "available")
UNDER = f"(?:licen[sc]ed|{'|'.join(GIVEN)}) under(?: the)?(?: terms of)?(?: the)?"
NUMBER = "(?: licen[sc]e)?(?: version| v)? v?"
CLEAR = "(?: licen[sc]e(?: version| v)?| version) v?"
#: What stands around a name in a family's form: one of these is in every match.
SIGNS = {TAG: ("spdx",), NOTICE: ("licen", *GIVEN), VERSION: ("licen", "version"), NAME: ("licen",)}

#: Rules that belong to no family: label, keyword, form, expression.
SINGLE = [
    ("public-domain", "domain", NOTICE, "(?:dedicated to|released into|placed in) the public domain"),
    ("public-domain", "domain", NAME, "public domain"),
    ("all-rights-reserved", "reserved", NAME, "all rights reserved"),
    ("copyright", "copyright", NAME, "copyright (?:c )?(?:19|20)[0-9][0-9]"),
    ("mit", "hereby", NOTICE, "permission is hereby granted free of charge"),
    ("isc", "permission", NOTICE, "permission to use copy modify and or distribute this software"),
    ("bsd", "redistribution", NOTICE, "redistribution and use in source and binary forms"),
]


def rules() -> list[dict]:
    """All rules in order: label, keyword, signs, regex, priority, confidence, base."""
    found = []

    def add(label, keyword, form, expression, signs=None, base=False):
        found.append({"label": label, "keyword": keyword, "signs": list(signs or SIGNS[form]),
                      "regex": f"(?<= ){expression}(?= )",
                      "priority": form[0], "confidence": form[1], "base": base})

    for label, keyword, name, versions in FAMILIES:
        add(label, keyword, TAG, f"spdx license identifier {name}")
        add(label, keyword, NOTICE, f"{UNDER} {name}(?: licen[sc]e)?")
        add(label, keyword, NAME, f"{name} licen[sc]e")
        for version in versions:
            exact = f"{label}-{version.replace(' ', '.')}"
            add(exact, keyword, TAG, f"spdx license identifier {name} {version}(?: only| or later)?")
            add(exact, keyword, NOTICE, f"{UNDER} {name}{NUMBER}{version}(?: or later)?")
            add(exact, keyword, VERSION, f"{name}{CLEAR}{version}(?: or later)?")
    for label, keyword, form, expression in SINGLE:
        add(label, keyword, form, expression, signs=(keyword,))
    for phrase, label in BASE:
        add(label, phrase.split(" ")[-2], NAME, phrase, base=True)
    return found


#: The signs of all rules: a text with none of these, in lower case, holds no detection.
KEYWORDS = tuple(sorted({sign for rule in rules() for sign in rule["signs"]}))

RULES = ("array<struct<label:string,keyword:string,signs:array<string>,regex:string,priority:int,"
         "confidence:double,base:boolean>>")
MARK = "\u0001"


def detections(text: Column) -> Column:
    """Array of (start, stop, label, priority, confidence, base), stop excluded, not yet resolved."""
    # Each value bound by `of` is computed once, however often it is used.
    def of(value: Column, use) -> Column:
        return F.element_at(F.transform(F.array(value), use), 1)

    words = F.concat(F.lit(" "), F.trim(F.regexp_replace(lower_ascii(text), NOT_WORD, " ")), F.lit(" "))
    every = F.from_json(F.lit(json.dumps(rules())), RULES)

    def places(joined: Column, rule: Column) -> Column:
        marked = F.split(F.regexp_replace(joined, rule.regex, F.lit(f"{MARK}$0")), " ")
        starts = F.filter(F.transform(marked, lambda word, at: F.when(
            F.startswith(word, F.lit(MARK)), at - 1)), lambda at: at.isNotNull())
        sizes = F.transform(F.regexp_extract_all(joined, rule.regex, F.lit(0)),
                            lambda found: F.size(F.split(found, " ")))
        return F.zip_with(starts, sizes, lambda start, size: F.struct(
            start.alias("start"), (start + size).alias("stop"), rule.label.alias("label"),
            rule.priority.alias("priority"), rule.confidence.alias("confidence"), rule.base.alias("base")))

    def scanned(joined: Column) -> Column:
        tried = F.filter(every, lambda rule: F.contains(joined, rule.keyword) & F.exists(
            rule.signs, lambda sign: F.contains(joined, sign)) & F.regexp_like(joined, rule.regex))
        return F.flatten(F.transform(tried, lambda rule: places(joined, rule)))

    return of(words, scanned)


def scan(docs: DataFrame) -> DataFrame:
    """One row per detection, and one with nulls for a text without: row, doc_id, n_words, and
    start, stop, label, priority, confidence, base, kept.

    kept is false where the interval lies within one of a rule of equal or better priority
    (of equal intervals and priorities the first rule stays). A null text counts as empty;
    it has no words. Other columns are ignored. A document's detections are sorted together,
    documents are not.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lower = F.lower(text)
    gate = F.lit(False)
    for keyword in KEYWORDS:
        gate = gate | F.contains(lower, F.lit(keyword))
    # The row's number comes before the explosion, so that a text's detections share it.
    found = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").select(
        "row", "doc_id", F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"),
        F.posexplode_outer(F.when(gate, detections(text))).alias("nth", "found"))
    before = Window.partitionBy("row").orderBy(
        "start", F.col("stop").desc(), "priority", "nth").rowsBetween(Window.unboundedPreceding, -1)
    found = found.select("row", "doc_id", "n_words", "nth", "found.*")
    inner = F.lit(False)
    for level in (TAG[0], NOTICE[0], VERSION[0], NAME[0]):
        reach = F.max(F.when(F.col("priority") == level, F.col("stop"))).over(before)
        inner = inner | ((F.col("priority") >= level) & (F.coalesce(reach, F.lit(0)) >= F.col("stop")))
    return found.withColumn("kept", F.col("start").isNotNull() & ~F.coalesce(inner, F.lit(False)))


def license_summary(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    Base phrases count at all their places, resolved or not; labels are theirs and those of
    kept detections. score is the highest confidence of a detection, 0 without any. A null or
    empty text has no words and no labels; repeated rows are scanned each; other columns are ignored; an
    empty table gives an empty result. A text of any length is scanned whole, as one string of its words.
    """
    base = F.coalesce(F.col("base"), F.lit(False))

    def listed(condition: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")

    return scan(docs).groupBy("row", "doc_id", "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        listed(base).alias("base_labels"), listed(base | F.col("kept")).alias("labels"),
        F.coalesce(F.max(F.when(base | F.col("kept"), F.col("confidence"))), F.lit(0.0)).alias("score"),
    ).drop("row")


def op3_license_scan(spark, folder: str) -> DataFrame:
    """Every document with the licenses that it mentions."""
    return license_summary(table(spark, folder, "documents"))
