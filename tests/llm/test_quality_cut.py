from __future__ import annotations

import random
import zlib

from ledgerloom.llm import quality


def test_cut_is_taken_over_all_labels_and_not_over_the_sample(table):
    rng, rows, labels = random.Random(5), [], []
    for i in range(900):  # classes that overlap: 85 % good, of which a sample by label shows every second one
        good = rng.random() < 0.85
        shout = min(max(rng.gauss(0.35 if good else 0.55, 0.15), 0), 1)
        words = [rng.choice(("BUY!!", "NOW!!", "###")) if rng.random() < shout else rng.choice(("river", "town", "sleeps,", "and", "the")) for _ in range(60)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(good)))
    docs, known = table(rows, "doc_id long, text string"), table(labels, "doc_id long, quality int", "labels")
    learnt = {i: q for i, q in labels if zlib.crc32(str(i).encode()) % 4 != 2}
    for per_label in (60, 2500):  # a balanced sample, and all labels
        got = {r.row.doc_id: r.score for r in quality.score(docs, quality.fit(docs, known, per_label)).collect()}
        assert abs(sum(got[i] >= 0.7 for i in learnt) - sum(learnt.values())) <= 1
