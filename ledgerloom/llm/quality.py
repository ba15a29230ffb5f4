"""Operator 3, quality scores by Bradley-Terry ranking.

A preference pair is a text labelled good over one labelled bad. The logistic loss on the
differences of their features gives the weights of a linear score, from a bounded sample;
the score's quantile at the share of bad texts, both over all labelled texts that aren't held
out, becomes the threshold, which is put at 0.7 on the output scale.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bytewise as bw
from ledgerloom.llm import shared
from ledgerloom.llm.language import held_out

#: Expected number of training texts of each label (a hash of the id chooses them).
PER_LABEL = 2500
#: Bad texts that each good one is paired with, and the other way round.
OPPONENTS = 8
THRESHOLD = 0.7
#: The cut's rank is off by one row in this many at most.
ACCURACY = 100_000
_KINDS = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": [32], "newline": [10], "stop": b".", "comma": b",",
    "shout": b"!?", "pipe": b"|", "sign": b"#$%&*^~=+<>", "mark": b"-_/\\:;'\"()[]{}@", "high": range(128, 256), "control": [*range(0, 9), *range(14, 32), 127],
}
_KIND = np.zeros(256, np.uint8)
for _i, _bytes in enumerate(_KINDS.values(), 1):
    _KIND[list(_bytes)] = _i


def features(texts: pa.Array) -> np.ndarray:
    """A row of numbers for each whole text: shares of kinds of bytes, and how words and lines repeat."""
    out = []
    for c in bw.chunks(texts):
        kind = _KIND[c.data].astype(np.int64)
        w = bw.words(c, bw.NOT_SPACE)
        length = (w.end - w.start).astype(np.float64)
        lead = kind[w.start]
        tail = kind[w.end - 1]
        for i in range(c.rows):
            lo, hi = c.offsets[i], c.offsets[i + 1]
            a, z = w.first[i], w.first[i + 1]
            n, m = max(hi - lo, 1), z - a
            share = np.bincount(kind[lo:hi], minlength=len(_KINDS) + 1)[1:] / n
            h, own = w.hash[a:z], length[a:z]
            if m:
                distinct = len(np.unique(h)) / m
                again = (h[1:] == h[:-1]).mean() if m > 1 else 0.0
                three = h[:-2] * np.uint64(bw.SEQ[0]) + h[1:-1] * np.uint64(bw.SEQ[1]) + h[2:]
                trigram = len(np.unique(three)) / len(three) if m > 2 else 1.0
                head, foot = np.bincount(lead[a:z], minlength=len(_KINDS) + 1) / m, np.bincount(tail[a:z], minlength=len(_KINDS) + 1) / m
                words = [np.log1p(m), distinct, again, trigram, own.mean(), own.std(), np.minimum(own.max(), 60), (own == 1).mean(), head[1], head[2], foot[6], foot[7], foot[8], foot[10], foot[1]]
            else:
                words = [0.0] * 15
            out.append([*share, *words])
    x = np.array(out, np.float64).reshape(len(texts), len(_KINDS) + 15)
    return np.hstack([x, np.sqrt(np.abs(x)), np.minimum(x, 1) ** 2])


@dataclass
class Model:
    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float
    #: Score of every text where nothing could be learnt.
    constant: float | None = None

    @classmethod
    def fit(cls, x: np.ndarray, label: np.ndarray) -> Model:
        share = float(label.mean()) if len(label) else 0.5
        if not len(label) or not 0 < share < 1:
            return cls(np.zeros(0), np.ones(0), np.zeros(0), 0.0, share)
        middle, spread = x.mean(0), x.std(0)
        spread[spread < 1e-9] = 1
        z = np.clip((x - middle) / spread, -6, 6)
        good, bad, rng = z[label == 1], z[label == 0], np.random.default_rng(3)
        a = np.concatenate([np.repeat(np.arange(len(good)), OPPONENTS), rng.integers(0, len(good), OPPONENTS * len(bad))])
        b = np.concatenate([rng.integers(0, len(bad), OPPONENTS * len(good)), np.repeat(np.arange(len(bad)), OPPONENTS)])
        d = good[a] - bad[b]
        w, ridge = np.zeros(d.shape[1]), 1e-3 * len(d)
        for _ in range(25):  # Newton steps on the logistic loss of the differences
            p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
            grad = d.T @ p - ridge * w
            hess = (d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(len(w))
            step = np.linalg.solve(hess, grad)
            w += step
            if np.abs(step).max() < 1e-6:
                break
        return cls(middle, spread, w, float(np.quantile(z @ w, 1 - share)))

    def linear(self, texts: pa.Array) -> np.ndarray:
        return np.clip((features(texts) - self.middle) / self.spread, -6, 6) @ self.weights

    def __call__(self, texts: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        s = self.linear(texts) - self.cut
        return 1 / (1 + np.exp(-np.clip(s + np.log(THRESHOLD / (1 - THRESHOLD)), -40, 40)))


def _known(labels: DataFrame) -> DataFrame:
    """doc_id, quality of the labelled rows that aren't held out."""
    return labels.filter(labels["quality"].isin(0, 1) & labels["doc_id"].isNotNull() & ~held_out(labels["doc_id"])).select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("quality"))


def _weights(docs: DataFrame, known: DataFrame, per_label: int = PER_LABEL) -> Model:
    """Weights from a bounded sample of ``known`` (see ``PER_LABEL``); its cut is the sample's."""
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    if not counts:
        return Model.fit(np.zeros((0, 1)), np.zeros(0))
    share = F.create_map(*[F.lit(x) for v, n in counts.items() for x in (v, min(1.0, per_label / n))])
    sample = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share[F.col("quality")] * (1 << 30))
    # the sample's ids: about 2 * per_label rows, whatever the input's size
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).join(F.broadcast(sample), "doc_id")

    def rate(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(list(features(b.column(1))), pa.list_(pa.float64()))], names=["doc_id", "quality", "x"])

    got = sorted(rows.select("doc_id", "text", "quality").mapInArrow(rate, "doc_id long, quality int, x array<double>").collect())
    if not got:
        return Model.fit(np.zeros((0, 1)), np.zeros(0))
    return Model.fit(np.array([r["x"] for r in got]), np.array([r["quality"] for r in got]))


def _linear(docs: DataFrame, model: Model, keep: tuple[str, ...] | None) -> DataFrame:
    """``row`` (struct of ``keep``), id, and the linear score of every row, written once."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # three numbers a feature
    told = docs.withColumn("_row", F.struct("*") if keep is None else F.struct(*[docs[c] for c in keep])).withColumn("_id", docs["doc_id"].cast("long"))
    return shared.materialize(bw.annotate(told, lambda texts: [shipped.value.linear(texts)], "s double", ("_row", "_id")).select(F.col("row._row").alias("row"), F.col("row._id").alias("id"), "s"), "linear")


def _cut(linear: DataFrame, known: DataFrame) -> float:
    """Between the scores at the rank of the number of bad texts and above, over all rows of ``known`` with a text."""
    scores = shared.materialize(linear.select(F.col("id").alias("doc_id"), "s").join(known, "doc_id").select("s", "quality"), "scores")
    n, bad = scores.agg(F.count("*"), F.count(F.when(F.col("quality") == 0, 1))).first()
    low = scores.agg(F.percentile_approx("s", (bad - 0.5) / n, ACCURACY)).first()[0]
    high = scores.filter(F.col("s") > low).agg(F.min("s")).first()[0]
    return low if high is None else (low + high) / 2


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model:
    """Weights from a bounded sample of the labelled rows that aren't held out, the cut from all of them; for ``score`` on other documents."""
    known = _known(labels)
    model = _weights(docs, known, per_label)
    if model.constant is not None:
        return model
    told = docs.join(known.select(F.col("doc_id").alias("_known")).distinct(), docs["doc_id"].cast("long") == F.col("_known"), "left_semi")
    return replace(model, cut=_cut(_linear(told, model, ("doc_id",)), known))


def fit_and_score(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] | None = None, per_label: int = PER_LABEL) -> DataFrame:
    """``score`` by what ``fit`` learns from the same documents: each text's features are computed once for the cut and the scores."""
    known = _known(labels)
    model = _weights(docs, known, per_label)
    if model.constant is not None:
        return score(docs, model, keep)
    linear = _linear(docs, model, keep)
    far = F.greatest(F.lit(-40.0), F.least(F.lit(40.0), F.col("s") - F.lit(_cut(linear, known)) + F.lit(float(np.log(THRESHOLD / (1 - THRESHOLD))))))
    return linear.select("row", (1 / (1 + F.exp(-far))).alias("score"))


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``row`` (struct of the columns ``keep``, all where None) and score of every row.

    Null texts count as empty; an empty text has a score like any other. If the labels show
    only one class, or none, every score is the share of good ones (0.5 without labels).
    Repeated rows are scored alike, and texts that tie have one score; very long texts are
    read whole, some megabytes at a time; an empty table gives no rows.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # three numbers a feature
    return bw.annotate(docs, lambda texts: [shipped.value(texts)], "score double", keep)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = fit_and_score(shared.read(spark, sf_dir, "documents"), shared.read(spark, sf_dir, "labels"), keep=("doc_id",))
    return scored.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
