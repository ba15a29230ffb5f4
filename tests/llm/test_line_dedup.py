from __future__ import annotations

import hashlib

import duckdb

from ledgerloom.llm import line_dedup, shared

BLANKS = " \t\n\x0b\x0c\r"
SMALL = {i: i + 32 for i in range(65, 91)}


def brute(rows, min_chars=20, min_docs=3):
    key = lambda line: line.strip(BLANKS).translate(SMALL)
    held = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            held.setdefault(key(line), set()).add(d)
    low = lambda d: (d is not None, d or 0)
    keep = {k: max(ds, key=low) for k, ds in held.items() if len(k) >= min_chars and len(ds) >= min_docs}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if keep.get(key(x), d) == d]
        out.append((d, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=str)


def told(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", "text").collect()), key=str)


SAME = "this very line is shared by many"
ROWS = [
    (1, f"{SAME}\nown one"), (2, f"\t {SAME.upper()} \r\nown two\n"), (3, f"{SAME}\n{SAME}"), (4, f"x\n{SAME}\nx\n\x0b{SAME}\x0c"), (4, f"again\n{SAME}"), (5, None), (6, ""), (None, f"{SAME}\nno id"), (None, "\n\n"),
    (7, "only two hold this line here\nÉcole É"), (8, "only two hold this line here"), (8, "only two hold this line here"), (9, "nineteen characters"), (10, "nineteen characters"), (11, "nineteen characters"), (-3, f"{SAME}"),
    (12, "twenty code points é"), (13, "twenty code points é"), (14, " twenty code points é "), (15, "twenty code points É"), (16, " " + SAME), (17, "\n".join(f"line number {i} of a very long text" for i in range(20_000))),
    (18, f"line number 7 of a very long text\n{SAME}"), (19, "line number 7 of a very long text"),
]


def test_edges(table):
    docs = table([(d, t, 5, d) for d, t in ROWS], "doc_id long, text string, n_lines int, key long")
    assert told(line_dedup.line_dedup(docs)) == brute(ROWS)
    assert told(line_dedup.line_dedup(docs, 5, 2)) == brute(ROWS, 5, 2)
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0


def test_hot_lines_are_salted(table, monkeypatch):
    monkeypatch.setattr(shared, "FEW", 2)
    assert told(line_dedup.line_dedup(table(ROWS, "doc_id long, text string"))) == brute(ROWS)


def test_frames_that_are_no_files(spark):
    assert told(line_dedup.line_dedup(spark.createDataFrame(ROWS, "doc_id long, text string"))) == brute(ROWS)


def test_whole_table(spark, sf):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    found = sorted(tuple(r) for r in line_dedup.op11_line_dedup(spark, sf).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect())
    assert found == sorted(con.sql(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({line_dedup.OP11_SQL})").fetchall())
    rows = [(r.doc_id, r.text) for r in shared.read(spark, sf, "documents").collect()]
    assert found == sorted((d, n, gone, hashlib.sha256(t.encode()).hexdigest()) for d, n, gone, t in brute(rows))
    assert any(n for _, _, n, _ in found)


def test_texts_are_dealt_once(spark, sf):
    plan = line_dedup.line_dedup(shared.read(spark, sf, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Python" not in plan and "CartesianProduct" not in plan
