"""Operator 8, language identification by error-correcting output codes.

Every language has a codeword. One linear classifier over hashed byte trigrams predicts
each bit; the loss-weighted distance of the margins to each codeword, weighted by how
good each bit's classifier was in training, chooses the language. Two codewords at nearly
the same distance make a text ambiguous; how near is learnt from texts that the classifiers
haven't seen and from mixes of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bytewise as bw
from ledgerloom.llm import shared

BUCKETS = 2048
#: Expected number of training texts of each language (a hash of the id chooses them).
PER_LANGUAGE = 600
#: A text is ambiguous where the losses of the two nearest codewords differ by a smaller part of
#: their sum than for all but this share of texts of one language.
UNUSUAL = 0.01
#: Texts of two languages, half and half, that the training looks at for each pair of languages.
MIXES = 50
#: Training rows that are taken to 64 bits at a time.
FITTED_TOGETHER = 256
UNKNOWN = "und"
#: ASCII letters in lower case and bytes of other alphabets stay; all else is a gap.
_FOLD = np.where(bw.ALNUM, bw.LOWER, 32).astype(np.uint8)
_FOLD[0x30:0x3A] = 32
_GAP = (0x202020 * 0x9E3779B1 & 0xFFFFFFFF) >> 21  # the bucket of three gaps


def trigrams(texts: pa.Array) -> np.ndarray:
    """Square roots of the shares of each hashed trigram; a row of zeros where there is none."""
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for c in bw.chunks(texts):
        b = _FOLD[c.data].astype(np.uint32)
        if len(b) < 3:
            continue
        at = ((((b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(21)).astype(np.int64)
        for i in range(c.rows):
            own = at[c.offsets[i] : max(c.offsets[i], c.offsets[i + 1] - 2)]
            if len(own):
                n = np.bincount(own, minlength=BUCKETS).astype(np.float32)
                n[_GAP] = 0
                out[c.first + i] = np.sqrt(n / max(n.sum(), 1))
    return out


def lettered(texts: pa.Array) -> np.ndarray:
    """Whether each text has a letter of any alphabet."""
    return pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def codewords(n: int) -> np.ndarray:
    """n rows of +1 and -1: of many random codes, the one whose nearest rows are farthest apart."""
    length = max(7, int(np.ceil(10 * np.log2(max(n, 2)) / 2)) | 1)
    rng, best, least = np.random.default_rng(8), None, -1
    for _ in range(200):
        code = rng.choice([-1, 1], (n, length))
        apart = (length - code @ code.T) // 2 + np.eye(n, dtype=int) * length
        split = np.abs(code.sum(0)) < n  # each bit must tell languages apart
        if n < 2 or (split.all() and apart.min() > least):
            best, least = code, apart.min()
    return (best if best is not None else code).astype(np.float32)


def _wide(x: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Which rows, and these with a constant 1 behind them in 64 bits, some at a time."""
    for at in range(0, len(x), FITTED_TOGETHER):
        part = slice(at, at + FITTED_TOGETHER)
        own = np.ones((len(x[part]), x.shape[1] + 1))
        own[:, :-1] = x[part]
        yield part, own


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    trust: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    #: Texts with a smaller gap between the two nearest codewords are ambiguous.
    least_gap: float = 0.0

    @classmethod
    def fit(cls, x: np.ndarray, languages: list[str]) -> Model:
        names = sorted({*languages})
        if not names:
            return cls([])
        code = codewords(len(names))
        bits = code[[names.index(v) for v in languages]]
        # each language counts alike
        count = {v: languages.count(v) for v in names}
        each = np.array([1 / count[v] for v in languages])[:, None] * len(languages) / len(names)
        n = x.shape[1] + 1
        square, told = np.zeros((n, n)), np.zeros((n, code.shape[1]))
        for part, own in _wide(x):
            square += own.T @ (own * each[part])
            told += own.T @ (bits[part] * each[part])
        square[np.diag_indices(n)] += 0.02
        w = np.linalg.solve(square, told)
        del square
        right = np.clip(sum(((own @ w) * bits[part] > 0).sum(0) for part, own in _wide(x)) / len(x), 0.5, 0.999)
        trust = np.log(right / (1 - right))
        trust = trust / trust.sum() if trust.sum() > 0 else np.full(len(trust), 1 / len(trust))
        return cls(names, code, w.astype(np.float32), trust.astype(np.float32))

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Of each row of trigrams to each codeword."""
        margin = x @ self.weights[:-1] + self.weights[-1]
        return (np.exp(-np.clip(margin[:, None, :] * self.code[None], -5, 5)) * self.trust).sum(2)

    def gaps(self, x: np.ndarray) -> np.ndarray:
        """How much farther the second codeword is than the first, as a part of their sum."""
        if len(self.languages) < 2 or not len(x):
            return np.full(len(x), np.inf)
        two = np.partition(self.losses(x), 1, axis=1)
        return (two[:, 1] - two[:, 0]) / (two[:, 1] + two[:, 0])

    def __call__(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and ambiguity of each text."""
        known = lettered(texts) & bool(self.languages)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        x = trigrams(texts)
        loss = self.losses(x)
        order = np.argsort(loss, axis=1, kind="stable")
        first = loss[np.arange(len(loss)), order[:, 0]]
        near = np.exp(-4 * (loss - first[:, None]))
        score = np.where(known, 1 / near.sum(1), 0.0).astype(float)
        unsure = ~known | (self.gaps(x) < self.least_gap)
        return [self.languages[o] if k else UNKNOWN for o, k in zip(order[:, 0], known, strict=True)], score, unsure


def train(x: np.ndarray, languages: list[str]) -> Model:
    """A model of all rows, with the gap under which a text counts as ambiguous.

    Each half of the rows is judged by a model of the other half. The gap is the quantile
    ``UNUSUAL`` of texts of one language, but no more than mixes of two languages reach, so
    that languages far apart flag nothing without need.
    """
    model, clean, mixed = Model.fit(x, languages), [], []
    halves = [slice(k, None, 2) for k in (0, 1)]  # views, not copies
    rng = np.random.default_rng(8)
    for own, other in (halves, halves[::-1]):
        half = Model.fit(x[own], languages[own])
        if half.languages != model.languages or len(half.languages) < 2:
            return model
        away = np.array(languages)[other]
        clean.append(half.gaps(x[other])[np.isin(away, half.languages)])
        at = {v: np.flatnonzero(away == v) for v in half.languages}
        for a in half.languages:
            for b in half.languages:
                if a < b and len(at[a]) and len(at[b]):
                    i, j = rng.choice(at[a], MIXES), rng.choice(at[b], MIXES)
                    mixed.append(half.gaps(np.sqrt((x[other][i] ** 2 + x[other][j] ** 2) / 2)))
    if mixed:
        model.least_gap = float(min(np.quantile(np.concatenate(clean), UNUSUAL), np.concatenate(mixed).max()))
    return model


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text leaves 2 on division by 4; a null id is not one."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def examples(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame | None:
    """doc_id, lang, x (packed trigrams) of a bounded sample of the labelled rows that aren't held out (see ``PER_LANGUAGE``); None where there are none.

    Most of a row's trigrams are zeros; packed, it takes the driver, in each of the forms it has there, a fraction of its numbers.
    """
    rows = docs.filter(docs["lang"].isNotNull() & docs["text"].isNotNull() & docs["doc_id"].isNotNull() & ~held_out(docs["doc_id"]))
    rows = rows.select(docs["doc_id"], docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for v, n in counts.items() for x in (v, min(1.0, per_language / n))])
    sample = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))

    def features(batches):
        for b in batches:
            x = trigrams(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([zlib.compress(r, 1) for r in x], pa.binary())], names=["doc_id", "lang", "x"])

    return sample.select(F.col("doc_id").cast("string"), "text", "lang").mapInArrow(features, "doc_id string, lang string, x binary")


def unpacked(rows: list[bytes]) -> np.ndarray:
    """The trigrams that ``examples`` packs."""
    x = np.empty((len(rows), BUCKETS), np.float32)
    for i, r in enumerate(rows):
        x[i] = np.frombuffer(zlib.decompress(r), np.float32)
    return x


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from ``examples``."""
    sample = examples(docs, per_language)
    got = sorted(sample.collect()) if sample is not None else []  # in a fixed order, so that a run gives the same model
    return train(unpacked([r["x"] for r in got]), [r["lang"] for r in got]) if got else Model([])


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``row`` (struct of the columns ``keep``, all where None), lang_pred, score, ambiguous of every row.

    A text that is null or has no letter is ``und`` with score 0 and ambiguous; so is every
    text if no language could be learnt. Ties go to the language that sorts first. A text
    half in one language and half in another is told as one of them and ambiguous. Very long
    texts are read whole, in chunks. Repeated rows are judged alike; an empty table gives no rows.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # codes and weights: BUCKETS numbers a bit
    return bw.annotate(docs, lambda texts: shipped.value(texts), "lang_pred string, score double, ambiguous boolean", keep)


def known_language(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose language is told without ambiguity."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    return bw.where(docs, lambda texts: ~shipped.value(texts)[2])


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.read(spark, sf_dir, "documents")
    return identify(docs, fit(docs), keep=("doc_id",)).select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")
