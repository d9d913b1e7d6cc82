import re

import pytest
from pyspark.sql import functions as F

from gavelcast.llm import licenses
from gavelcast.llm.license_rules import WEIGHTS, rules

SMALL = "/root/testdata/sf0.001"
PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
TEXTS = [
    None, "", " \n\t", "...", "cc by", "CC-BY", "cc by cc by, CC/BY; cc-by-nc 4.0", "General public license", "the GNU General Public License, version 3.",
    "ALL RIGHTS RESERVED all rights all rights reserved", "İall rights reserved Kcc by", "éall rights reserved. cc by", "cc by",
    "Licensed under the Apache License, Version 2.0 (the \"License\")", "This work is released under the MIT License.", "SPDX-License-Identifier: GPL-2.0-or-later",
    "SPDX-License-Identifier: MIT", "you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3.",
    "see https://creativecommons.org/licenses/by-nc-sa/4.0/ and Creative Commons Attribution-ShareAlike 3.0 Unported License",
    "Alle Rechte vorbehalten. Tous droits réservés. mit 0 License", "© 2021 Foo, Copyright (c) 1999-2004 Bar, in the public domain; without warranty of any kind",
    "gplv3 lgpl-2.1+ GNU AGPL v3 or later mpl-2.0 cc0 1.0 universal", "cc by " * 700, "all rights reserved mit license " * 300, "x" * 200000 + " mit license"]


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain_base(text):
    words = words_of(text)
    places = [(i, label) for p, label in PHRASES.items() for i in range(len(words)) if tuple(words[i:i + len(p)]) == p]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def plain_detections(text):
    """All matches of all rules, then the suppression by comparing every two."""
    norm = " " + " ".join(words_of((text or "").replace("K", "Ⓚ").lower())) + " "
    found = []
    for i, r in enumerate(rules()):
        for m in re.finditer(f"(?<= )(?:{r.regex})(?= )", norm):
            start = norm.count(" ", 0, m.start()) - 1
            found.append((start, start + m.group().count(" ") + 1, r.priority, i, r.label))
    order = lambda d: (d[2], d[1] - d[0], -d[3])
    return sorted((d[4], d[3], d[2], d[0], d[1]) for d in found if not any(
        e[0] <= d[0] and e[1] >= d[1] and (e[2] > d[2] or e[2] == d[2] and order(e) > order(d)) for e in found))


def plain_score(base, kept):
    doubt = 1.0
    for label in sorted({*filter(None, base.split(",")), *(d[0] for d in kept)}):
        weight = max([WEIGHTS[d[2]] for d in kept if d[0] == label] + [0.5 if label in base.split(",") else 0.0])
        doubt *= 1 - weight
    return 1 - doubt


def check(rows, texts):
    for r in rows:
        text = texts[r["doc_id"]]
        base = plain_base(text)
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base, text
        kept = plain_detections(text)
        assert sorted((d["label"], d["rule"], d["priority"], d["start"], d["end"]) for d in r["detections"]) == kept, text
        assert r["labels"] == ",".join(sorted({*filter(None, base[4].split(",")), *(d[0] for d in kept)}))
        assert r["score"] == pytest.approx(plain_score(base[4], kept)) and 0 <= r["score"] <= 1


def test_equals_all_rules_on_edge_cases(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = licenses.scan(docs).collect()
    assert len(got) == len(TEXTS)
    check(got, dict(enumerate(TEXTS)))


def test_equals_all_rules_on_the_test_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = licenses.scan(docs).collect()
    check(got, texts)
    assert sum(bool(r["labels"]) for r in got) > 0


def test_expected_labels(spark):
    want = {"Licensed under the Apache License, Version 2.0.": "apache-2.0", "This work is licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc-4.0,grant",
            "under the MIT License.": "mit", "the GNU General Public License, version 3.": "gpl,gpl-3.0", "Ich komme mit 0 Euro": "",
            "spdx-license-identifier: mit": "mit", "All rights reserved.": "reserved", "Mozilla Public License 2.0": "mpl-2.0", "no word of it": ""}
    docs = spark.createDataFrame(list(enumerate(want)), "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(docs).collect()}
    assert [got[i] for i in range(len(want))] == list(want.values())


def test_there_are_hundreds_of_rules_and_each_key_is_in_what_its_rule_matches():
    assert len(rules()) >= 300 and all(r.priority in WEIGHTS and r.key for r in rules())
    # A key may hold what the regex spells with choices; a few real lines check the gates in the tests above.
    for r in rules():
        plain = r.regex.replace("licen[sc]e", "license").replace("licen[sc]ed", "licensed")
        assert r.key in plain or any(part in plain for part in r.key.split(" ")), r


def test_clashing_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "cc by", 7, "x")], "doc_id long, text string, n_words int, norm string").withColumn("row", F.lit(1))
    got = licenses.scan(docs)
    r = got.first()
    assert (r["n_words"], r["norm"], r["row"], r["base_labels"]) == (2, "x", 1, "cc-by")
    assert licenses.scan(docs.where("false")).collect() == []


def test_no_python_and_no_shuffle_in_the_plan(spark, capsys):
    licenses.scan(spark.read.parquet(f"{SMALL}/documents.parquet")).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
