"""Quality classifier: naive Bayes support vectors.

A text's features are indicators of n-grams, whether each occurs at all: of
words, of word shapes (runs of upper case, lower case and digits shortened to
one sign, other characters as they are, one mark when a word repeats the one
before it) in ones, twos and threes.  Each indicator is scaled by the log
ratio of its smoothed shares in the two classes (the naive Bayes part), the
vector is brought to length one, and a linear hinge-loss model is fitted by
dual coordinate descent.  Margins become scores by a logistic curve fitted on
documents that the model did not see.

The model is fitted on a documented, bounded sample: the TRAIN_ROWS labelled
documents allowed for learning whose ids hash lowest.  Labels, language,
source and id are never features.  Every text is scored whole.

Defined results: null, empty and blank texts have no features and get the
score of the intercept; equal texts get equal scores; labels that are null,
or whose document is missing, teach nothing; with fewer than two classes to
learn from, every score is the share of label 1 (0.5 without labels).  An
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risingtide.llm.common import BoundedCache, as_row, from_row, texts

#: Labelled documents the model is fitted on, at most.
TRAIN_ROWS = 6000
#: Hash buckets of all n-grams; an n-gram counts if so many documents have it.
BUCKETS, MIN_DOCS = 1 << 19, 5
COST, EPOCHS = 1.0, 30
CALIBRATE_EVERY = 4
CACHED_WORDS = 200_000

_RUNS = re.compile(r"(.)\1+")


#: Runs of more bytes than this without blanks are read as several words.
LONG_RUN, PIECE = 64, 8
_PARTS = re.compile(r"[^\W_]+(?:[\W_]+|$)|[\W_]+")


def shape(word: str) -> str:
    """THE!! -> X!, Ende, -> Xx, and 24be -> 9x."""
    signs = "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in word)
    return _RUNS.sub(r"\1", signs)


def words_of(text: str | None) -> list[bytes]:
    """The words of a whole text.  A run of more than LONG_RUN bytes is cut
    behind its punctuation, and what is still longer into pieces of PIECE
    characters, so that a script without blanks has words that texts share."""
    words = (text or "").encode().split()
    if len(max(words, key=len, default=b"")) <= LONG_RUN:
        return words
    out = []
    for w in words:
        if len(w) <= LONG_RUN:
            out.append(w)
            continue
        for part in _PARTS.findall(w.decode()):
            cut = [part] if len(part) <= PIECE * 2 else [part[s:s + PIECE] for s in range(0, len(part), PIECE)]
            out += [c.encode() for c in cut]
    return out


def _code(word: bytes) -> int:
    """Hash of the word in the upper 44 bits, of its shape in the lower 20."""
    own = xxhash.xxh3_64_intdigest(word.lower())
    return (own >> 21 << 20) | xxhash.xxh3_64_intdigest(shape(word.decode())) & 0xFFFFF


class Features:
    """n-gram indicators of texts; the word cache belongs to a task."""

    def __init__(self):
        self.codes = BoundedCache(_code, CACHED_WORDS)

    def __call__(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        if not words:
            return np.zeros(0, np.int64)
        codes = np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words)).view(np.uint64)
        shapes = codes & np.uint64(0xFFFFF)
        shapes[1:][codes[1:] == codes[:-1]] = np.uint64(1 << 20)
        with np.errstate(over="ignore"):
            a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
            one = (shapes + np.uint64(1)) * a
            two = (one[:-1] ^ b) * a + shapes[1:] * b
            three = (two[:-1] ^ a) * b + shapes[2:] * a
            grams = np.concatenate([(codes >> np.uint64(20)) * a, one, two, three])
        return np.unique((grams >> np.uint64(64 - 19)).astype(np.int64))


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int,
                            cost: float = COST, epochs: int = EPOCHS, seed: int = 1) -> np.ndarray:
    """Weights of the linear model of least hinge loss, L2 regularised."""
    w, alpha = np.zeros(size), np.zeros(len(rows))
    diag = np.array([v @ v for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            if diag[i] <= 0:
                continue
            g = y[i] * (w[rows[i]] @ values[i]) - 1
            new = min(max(alpha[i] - g / diag[i], 0.0), cost)
            if new != alpha[i]:
                w[rows[i]] += (new - alpha[i]) * y[i] * values[i]
                worst = max(worst, abs(new - alpha[i]) * diag[i])
                alpha[i] = new
        if worst < 1e-3:
            break
    return w


def logistic_curve(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of P(1) = 1 / (1 + exp(-slope * margin - offset)), by
    Newton's method with smoothed targets; the slope is never negative."""
    up, down = label.sum(), len(label) - label.sum()
    target = np.where(label == 1, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - target) * margin).sum() + 1e-3 * (a - 1), (p - target).sum()])
        s = p * (1 - p) + 1e-9
        h = np.array([[(s * margin * margin).sum() + 1e-3, (s * margin).sum()], [(s * margin).sum(), s.sum()]])
        step = np.linalg.solve(h, g)
        step *= min(1, 5 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(float(a), 0.0), float(b)


@dataclass
class Model:
    weights: np.ndarray  # of the scaled indicators, per bucket: ratio * w
    squares: np.ndarray  # ratio ** 2, per bucket
    bias: float
    slope: float
    offset: float

    def margin(self, features: np.ndarray) -> float:
        norm = self.squares[features].sum()
        return float(self.weights[features].sum() / np.sqrt(norm) + self.bias) if norm > 0 else self.bias

    def score(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(features) + self.offset, -30, 30))))


def _fit_part(rows: list[np.ndarray], label: np.ndarray) -> Model:
    docs = np.zeros((2, BUCKETS))
    for r, y in zip(rows, label, strict=True):
        docs[int(y), r] += 1
    known = docs.sum(axis=0) >= min(MIN_DOCS, max(1, len(rows) // 20))
    n = np.array([[max(1, (label == 0).sum())], [max(1, (label == 1).sum())]])
    share = (docs + 1) / (n + 2)
    ratio = np.where(known, np.log(share[1] / share[0]), 0.0)
    squares = ratio * ratio
    own = [r[known[r]] for r in rows]
    norms = [np.sqrt(squares[r].sum()) or 1.0 for r in own]
    # The intercept is one more feature, of value 1.
    values = [np.append(ratio[r] / z, 1.0) for r, z in zip(own, norms, strict=True)]
    w = dual_coordinate_descent([np.append(r, BUCKETS) for r in own], values, np.where(label == 1, 1.0, -1.0), BUCKETS + 1)
    return Model((w[:BUCKETS] * ratio).astype(np.float32), squares.astype(np.float32), float(w[BUCKETS]), 1.0, 0.0)


def fit(rows: list[np.ndarray], label: np.ndarray) -> Model:
    label = np.asarray(label, dtype=np.int64)
    if len(set(label.tolist())) < 2:
        share = (label.sum() + 1) / (len(label) + 2) if len(label) else 0.5
        zero = np.zeros(BUCKETS, np.float32)
        return Model(zero, zero, 0.0, 1.0, float(np.log(share / (1 - share))))
    aside = np.arange(len(rows)) % CALIBRATE_EVERY == 0
    if len(set(label[~aside].tolist())) == 2 and len(set(label[aside].tolist())) == 2:
        part = _fit_part([r for r, a in zip(rows, aside, strict=True) if not a], label[~aside])
        curve = logistic_curve(np.array([part.margin(r) for r, a in zip(rows, aside, strict=True) if a]), label[aside])
    else:
        curve = (2.0, 0.0)
    model = _fit_part(rows, label)
    model.slope, model.offset = curve
    return model


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves remainder ``part``; a null id
    counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def labelled(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int) -> DataFrame:
    """doc_id, text, label of the ``rows`` labelled documents whose ids hash
    lowest.  Which they are depends on the ids alone."""
    own = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
           .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & learn)
           .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows))
    own = F.broadcast(own.select(F.col("doc_id").alias("_id"), "label"))  # ``rows`` rows at most
    return texts(docs).join(own, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "label")


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> Model:
    """The model; features are taken by the executors, the driver gets those
    of TRAIN_ROWS ids.  An id that stands for several texts teaches by one of
    them, the one whose features sort first."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            rows = [features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([r.astype(np.int32).tobytes() for r in rows], pa.binary())],
                names=["doc_id", "label", "features"])

    got = (labelled(docs, labels, "quality", learn, TRAIN_ROWS)
           .mapInArrow(take, "doc_id long, label int, features binary")
           .groupBy("doc_id", "label").agg(F.min("features").alias("features")).collect())
    got.sort(key=lambda r: (r["doc_id"], r["label"], bytes(r["features"])))
    order = np.random.default_rng(7).permutation(len(got))
    rows = [np.frombuffer(got[i]["features"], np.int32) for i in order]
    return fit(rows, np.array([got[i]["label"] for i in order]))


def scored(rows: DataFrame, model: Model, text) -> DataFrame:
    """``rows`` with ``score``; ``text`` takes the texts from a batch."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # 2 * BUCKETS numbers
    schema = rows.select("*", F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, features = shared.value, Features()
        for batch in batches:
            score = pa.array([own.score(features(t)) for t in text(batch).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, score], names=[*batch.schema.names, "score"])

    return rows.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(docs, labels, ~held_out(F.col("doc_id"), parts, part))
    return scored(texts(docs), model, lambda batch: batch.column(1)).select(
        "doc_id", held_out(F.col("doc_id"), parts, part).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep(docs: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` not rejected, with their own columns."""
    model = train(docs, labels, ~held_out(F.col("doc_id"), parts, part))
    scores = scored(as_row(docs), model, lambda batch: batch.column(0).field("text").cast(pa.string()))
    return from_row(scores.filter(F.col("score") >= threshold))
