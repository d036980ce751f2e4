import random
import re

from helpers import documents
from test_decontaminate import words_of

from creditmart.llm import licenses, queries

PHRASES = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}


def slow_base(text):
    words = words_of(text)
    places = sorted((i, x) for x, p in PHRASES.items() for i in range(len(words)) if words[i : i + len(p)] == p)
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_query_base_against_brute_force(spark, small):
    folder = small.replace("0.001", "0.01")
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.QUERIES["op7_license_scan"](spark, folder).collect()
    assert len(rows) == len(docs) and any(r.n_base for r in rows)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == slow_base(docs[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert any("cc-by-nc-4.0" in r.labels for r in rows) and any("gpl-3.0" in r.labels for r in rows)


def labels(text):
    scanner = licenses.Scanner(licenses.rules())
    return scanner.scan([w.decode() for w in licenses.words_of(text.encode())])


def test_rules():
    ordered = licenses.rules()
    assert len(ordered) > 300
    for rule in ordered:
        re.compile(rule.pattern)
    for text, expected in (
        ("SPDX-License-Identifier: GPL-2.0-or-later", {"gpl-2.0"}), ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}),
        ("the MIT-License", {"mit"}), ("All rights reserved", {"proprietary"}), ("nothing here", set()),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted", {"bsd"}),
        ("GNU Lesser General Public License, version 2.1 or any later version", {"lgpl-2.1"}),
        ("Mozilla Public License 2.0 or EPL 2.0", {"mpl-2.0", "epl-2.0"})):
        assert {d[2] for d in labels(text)[1]} == expected, text


def test_every_match_passes_the_gates():
    """A text that a rule matches holds the longest word of the rule's keyword."""
    plain = re.compile(r"^[a-z0-9 ]+$")
    for rule in licenses.rules():
        if plain.match(rule.pattern):
            assert max(rule.keyword.split(), key=len) in rule.pattern.split(), rule


def test_suppression_against_all_pairs():
    draw = random.Random(9)
    for _ in range(300):
        found = sorted({(a, a + draw.randint(1, 9), draw.randint(0, 2), n) for n, a in enumerate(draw.choices(range(15), k=12))})
        better = lambda x, y: (x[2], x[0] - x[1], x[3]) < (y[2], y[0] - y[1], y[3])
        expected = [
            d for d in found
            if not any(o != d and o[0] <= d[0] and d[1] <= o[1] and o[2] <= d[2] and ((o[0], o[1]) != (d[0], d[1]) or better(o, d)) for o in found)]
        assert sorted(licenses.suppress(found)) == sorted(expected)


def test_edges(spark):
    docs = documents(spark, [(1, None), (2, ""), (None, "MIT License"), (4, "mit license " * 30_000), (4, "é"), (4, "é")])
    docs = docs.withColumnRenamed("lang", "_scanned").withColumnRenamed("source", "Score")
    out = licenses.scan(docs)
    rows = {(r.doc_id, (r.text or "")[:3]): (r.n_words, len(r.base)) for r in out.collect()}
    assert rows == {(1, ""): (0, 0), (2, ""): (0, 0), (None, "MIT"): (2, 1), (4, "mit"): (60_000, 30_000), (4, "é"): (1, 0)}
    assert "_scanned" in out.columns and licenses.scan(docs.limit(0)).count() == 0
