from __future__ import annotations

import re

from ledgerloom.llm import licenses


def base(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    at, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))


def test_base_equals_brute_force(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet").collect()}
    rows = licenses.op5_license_scan(spark, sf.replace("0.001", "0.01")).collect()
    assert len(rows) == len(texts) and sum(r.n_base for r in rows) > 5
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id])
        assert {*filter(None, r.base_labels.split(","))} <= {*r.labels.split(",")} and 0 <= r.score <= 1


def test_rules():
    scan = licenses.Scanner()
    assert len(licenses.rules()) > 200
    for text, label in [
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"),
        ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
        ("Released under the MIT License.", "mit"),
        ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
        ("GNU Lesser General Public License version 2.1", "gpl,lgpl-2.1"),
        ("All rights\nreserved. ALL RIGHTS RESERVED", "reserved"),
        ("nothing here, accby and omit license", ""),
    ]:
        found = scan(text)
        assert found["labels"] == label, text
        assert found["n_base"] == base(text)[1]
    long = "word " * 100_000 + "Released under the MIT License. " + "word " * 10
    assert scan(long)["detections"] == [("mit", 100_000, 100_005, 40)]


def test_suppression():
    assert licenses.suppress([(0, 10, 40, "a"), (2, 8, 40, "b"), (2, 12, 90, "c"), (2, 8, 95, "d"), (0, 10, 40, "a")]) == [(0, 10, 40, "a"), (2, 8, 95, "d"), (2, 12, 90, "c")]


def test_edges(table):
    docs = table([(1, None, "x"), (2, "", "y"), (None, "cc by", None), (2, "cc by", "z")], "doc_id long, text string, labels string")
    got = licenses.scan_licenses(docs).collect()
    assert sorted((r.n_words, r.labels, r.score) for r in got) == [(0, "", 0.0), (0, "", 0.0), (2, "cc-by", 0.4), (2, "cc-by", 0.4)]
    assert {r.row.labels for r in got} == {"x", "y", "z", None}
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_written_rules():
    lines = [x for x in (*licenses._TEXTS.strip().split("\n"), *licenses.CLAUSES.strip().split("\n"))]
    assert len(lines) >= 300 and len({*lines}) == len(lines)
    for line in lines:
        label, keyword, expression = (x.strip() for x in line.split("|", 2))
        assert label and len(keyword) > 2 and keyword == re.sub("[^a-z0-9 ]", "", keyword) and re.compile(expression)


def test_labels_equal_a_plain_search():
    """Every rule tried everywhere without the keyword gate, detections compared pair by pair."""
    import random

    scan, rng = licenses.Scanner(), random.Random(5)
    rules = licenses.rules()
    said = ["Licensed under the Apache License, Version 2.0", "GNU General Public License version 3", "CC BY-SA 4.0", "the MIT License", "all rights reserved", "copyright (c) 2019 2020 someone",
            "redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer", "some words", "gnu lgpl v3", "public domain", "cc by", "no"]
    for _ in range(40):
        text = ". ".join(rng.choice(said) for _ in range(rng.randint(0, 12)))
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.lower())
        line = f" {' '.join(words)} "
        found = [(m.start(), m.end(), r.priority, r.label) for r in rules for m in r.pattern.finditer(line)]
        kept = []
        for one in sorted({*found}, key=lambda x: (-x[2], x[0] - x[1], x[0], x[3])):
            if not any(s <= one[0] and one[1] <= e for s, e, _, _ in kept):
                kept.append(one)
        assert licenses.suppress(found) == sorted(kept)
        base_labels = {v for k, v in licenses.BASE.items() if f" {k} " in line}
        assert scan(text)["labels"] == ",".join(sorted(base_labels | {x[3] for x in kept}))
        assert scan(text)["detections"] == [(x[3], line.count(" ", 0, x[0]) - 1, line.count(" ", 0, x[1]), x[2]) for x in sorted(kept)]
        left = 1.0
        for p in {x[3]: x[2] for x in sorted(kept)}.values():
            left *= 1 - p / 100
        for _ in base_labels - {x[3] for x in kept}:
            left *= 0.5
        assert abs(scan(text)["score"] - (1 - left)) < 1e-6


def test_many_hits_take_time_in_proportion():
    import time

    scan = licenses.Scanner()
    scan("warm up")
    began = time.perf_counter()
    found = scan("All rights reserved under the MIT License. " * 50_000)
    assert found["n_base"] == 50_000 and found["last_word"] == 7 * 49_999 and time.perf_counter() - began < 10
