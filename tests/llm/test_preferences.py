from __future__ import annotations

from ledgerloom.llm import preferences


def test_pairs(table):
    rows = [
        (1, 0, "user", "hi", "x"), (1, 1, "assistant", "hello", "x"), (1, 2, "user", "more", "x"), (1, 3, "assistant", "a long answer", "x"),
        (2, 1, "assistant", "hello", "x"), (2, 0, "user", "hi", "x"), (2, 2, "user", "more", "x"), (2, 3, "assistant", "short", "x"),
        (3, 0, "user", "hi", None), (3, 1, "assistant", "hello", None),
        (4, 0, "user", "alone", None), (5, 0, None, None, None), (6, 0, None, "", None), (None, 0, "user", "hi", None),
        (7, 0, "user", "hi", None), (7, 1, "assistant", "hello", None),
    ]
    turns = table(rows, "conv_id long, turn long, role string, text string, prompt string", "conversations")
    convs = preferences.conversations(turns)
    got = {(r.chosen_id, r.rejected_id): r for r in preferences.format_pairs(preferences.pairs_by_opening(convs)).collect()}
    assert {*got} == {(1, 2), (1, 3), (1, 7), (5, 6)}
    r = got[1, 2]
    assert r.n_prompt_turns == 3 and r.prompt == "<|user|>\nhi<|end|>\n<|assistant|>\nhello<|end|>\n<|user|>\nmore<|end|>\n"
    assert [tuple(x) for x in r.chosen] == [("<|assistant|>\na long answer<|end|>\n", True)]
    assert [tuple(x) for x in r.rejected] == [("<|assistant|>\nshort<|end|>\n", True)]
    assert got[1, 3].rejected == [] and [x.trained for x in got[1, 3].chosen] == [False, True]
    assert got[5, 6].chosen == got[5, 6].rejected == [] and got[5, 6].n_prompt_turns == 1
    assert preferences.conversations(turns.limit(0)).count() == 0
    stale = preferences.format_pairs(preferences.pairs_with_stale_answers(convs)).collect()
    assert sorted((r.chosen_id, r.n_prompt_turns, r.rejected[0].text) for r in stale) == [(1, 3, "<|assistant|>\nhello<|end|>\n"), (2, 3, "<|assistant|>\nhello<|end|>\n")]


def test_very_long_turns_and_repeated_rows(table):
    long = "word " * 400_000
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", long), (1, 2, "user", "again"), (1, 3, "assistant", "z"), (2, 0, "user", "q"), (2, 0, "user", "q"), (2, 1, "assistant", "b"), (3, 0, "user", "q"), (3, 1, "assistant", long)]
    convs = preferences.conversations(table(rows, "conv_id long, turn long, role string, text string", "conversations"))
    got = {(r.chosen_id, r.rejected_id): r for r in preferences.format_pairs(preferences.pairs_by_opening(convs)).collect()}
    assert {*got} == {(1, 2), (1, 3)}
    assert got[1, 2].n_prompt_turns == 1 and len(got[1, 2].chosen[0].text) == len(long) + len("<|assistant|>\n<|end|>\n")
    assert [x.text for x in got[1, 2].rejected] == ["<|user|>\nq<|end|>\n", "<|assistant|>\nb<|end|>\n"]  # a row given twice is two turns
    assert got[1, 3].n_prompt_turns == 2 and len(got[1, 3].prompt) > len(long) and got[1, 3].rejected == []
    stale = preferences.format_pairs(preferences.pairs_with_stale_answers(convs)).collect()
    assert [(r.chosen_id, len(r.rejected[0].text)) for r in stale] == [(1, len(long) + len("<|assistant|>\n<|end|>\n"))]
    assert preferences.format_pairs(preferences.pairs_by_opening(convs.limit(0))).count() == 0
