from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.llm import exact_dedup


def told(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()), key=str)


ROWS = [(5, "a  b", 1), (2, "a b", 2), (9, "a\tb\n", 3), (9, "a b", 3), (1, None, 4), (3, "", 5), (None, "a b", 6), (None, "only null", None), (2, "a b", 2), (7, "x" * 100_000, 1)]
WANT = sorted(
    [(5, 2, 5, False), (2, 2, 5, True), (2, 2, 5, False), (9, 9, 1, True), (9, 2, 5, False), (1, 1, 2, True), (3, 1, 2, False), (None, 2, 5, False), (None, None, 1, True), (7, 7, 1, True)], key=str
)


def test_edges(table):
    docs = table(ROWS, "doc_id long, text string, keep_id int")
    assert told(exact_dedup.exact_dedup(docs)) == WANT
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "7", "9", "None"]
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


def test_colliding_digests_are_told_apart_by_bytes(table):
    docs = table(ROWS, "doc_id long, text string, keep_id int")
    weak = lambda text: F.unhex(F.hex(F.length(text) % 2))
    assert told(exact_dedup.exact_dedup(docs, digest=weak)) == WANT


def test_state_goes_on_between_calls(table, tmp_path):
    home = f"file://{tmp_path}/home"
    first = table([(5, "one"), (6, "two"), (8, "two")], "doc_id long, text string", "day1")
    assert told(exact_dedup.exact_dedup(first, home)) == [(5, 5, 1, True), (6, 6, 2, True), (8, 6, 2, False)]
    second = table([(10, "one"), (11, "three"), (12, "two")], "doc_id long, text string", "day2")
    assert told(exact_dedup.exact_dedup(second, home)) == [(10, 5, 2, False), (11, 11, 1, True), (12, 6, 3, False)]
