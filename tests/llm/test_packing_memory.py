from __future__ import annotations

from ledgerloom.llm import packing

from tests.llm.test_packing import ids_of


def test_text_with_more_new_words_than_are_remembered(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    own = packing.Tokens(packing.vocabulary())
    for text in (" ".join(f"old{i}" for i in range(30)), "old1 old2 " + " ".join(f"new{i}," for i in range(50)) + " old1", "old2 new3, once"):
        assert own(text) == ids_of(text)[:-1].tobytes()
