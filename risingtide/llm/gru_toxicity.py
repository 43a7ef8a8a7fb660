"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A text is read in overlapping windows of WINDOW words, STRIDE apart, all of
them, to its end.  A word enters as two vectors: one of its own (hashed) and
the mean of those of its character trigrams, so a word form never seen still
looks like its relatives.  A run without blanks of more than LONG_RUN
characters, such as prose in a script that sets none, is read as several
words: it is cut behind inner punctuation, and what is still longer into
pieces of PIECE characters that share two with the next, so each of its
trigrams enters once.  One gated recurrent layer runs over a window in
each direction, attention pools its states, and a linear unit gives the
window's logit; a document's logit is its highest window's, turned into a
score by a logistic curve fitted on documents kept aside.

Training is in numpy, on a documented, bounded sample: the TRAIN_ROWS labelled
documents allowed for learning whose ids hash lowest, and of those at most
TRAIN_POSITIVES and TRAIN_NEGATIVES with at most TRAIN_WORDS words.  Word and
trigram vectors start with the log ratio of their shares in the two classes in
one component.  Only documents are labelled, so each step trains on the
window that the network finds most toxic in each document.  Labels, language,
source and id never enter.

What a word adds to the gates does not depend on its place and is computed
once per distinct word; scoring then costs a few small matrix products per
word and direction for thousands of windows at a time.

Defined results: null, empty and blank texts are one window of no words;
equal texts get equal scores up to rounding; labels that are null, or whose
document is missing, teach nothing; with fewer than two classes to learn from
every score is the share of label 1 (0.5 without labels).  An empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risingtide.llm.common import texts
from risingtide.llm.nb_svm import held_out, labelled, logistic_curve

WINDOW, STRIDE = 32, 24
WORD_BUCKETS, CHAR_BUCKETS, DIM, HIDDEN, ATTENTION = 1 << 14, 1 << 13, 6, 8, 8
TRAIN_ROWS, TRAIN_POSITIVES, TRAIN_NEGATIVES, TRAIN_WORDS = 12_000, 1200, 2400, 700
STEPS, BATCH, RATE = 150, 64, 0.02
#: Parts of the sample; a document's ratios are taken from the other parts.
FOLDS = 8
#: Documents that must have a bucket for its vector to be trained, and for its ratio to count in full.
MIN_DOCS, FULL_TRUST = 10, 10
#: Vectors learn so many times slower than the rest.
VECTOR_RATE = 0.4
CALIBRATE_EVERY = 5
#: Words whose gate inputs a task keeps, 200 bytes each.
CACHED_WORDS = 250_000
PUNCTUATION = string.punctuation
LONG_RUN, PIECE = 64, 8
#: Where long runs are cut: also general and CJK punctuation and marks of no width.
BREAKS = "[!-/:-@\\[-`{-~\\u00a1-\\u00bf\\u0e2f\\u0e5a\\u0e5b\\u2000-\\u206f\\u3000-\\u303f\\ufe30-\\ufe4f\\ufeff\\uff01-\\uff0f]"
_PARTS = re.compile(f"{BREAKS}+|{BREAKS.replace('[', '[^', 1)}+{BREAKS}*")
#: Windows that are run through the network at once.
WINDOWS_AT_ONCE = 4096


def pieces_of(run: str) -> Iterator[str]:
    """The words that a long run without blanks is read as."""
    for part in _PARTS.findall(run):
        if len(part) <= LONG_RUN:
            yield part
        else:
            yield from (part[s:s + PIECE] for s in range(0, len(part) - 2, PIECE - 2))


def words_of(text: str | None) -> list[str]:
    words = (text or "").lower().split()
    if len(max(words, key=len, default="")) <= LONG_RUN:
        return words
    return list(chain.from_iterable(pieces_of(w) if len(w) > LONG_RUN else (w,) for w in words))


def inputs_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word buckets, trigram buckets of all words in a row, trigrams per
    word).  Punctuation around a word is left off; a word's trigrams include
    marks for its two ends."""
    cores = [w.strip(PUNCTUATION) or w for w in words]
    ids = np.fromiter((xxhash.xxh3_64_intdigest(c) % WORD_BUCKETS for c in cores), np.int64, len(cores))
    # Words hold no blanks, so a blank can separate them.
    code = np.frombuffer(("<" + "> <".join(cores) + ">").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    with np.errstate(over="ignore"):
        h = ((code[:-2] * np.uint64(0x9E3779B97F4A7C15) + code[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F)
             + code[2:]) * np.uint64(0x9E3779B97F4A7C15)
    gap = code == 32
    inside = ~(gap[:-2] | gap[1:-1] | gap[2:])
    grams = ((h >> np.uint64(40)) % np.uint64(CHAR_BUCKETS)).astype(np.int64)[inside]
    return ids, grams, np.bincount(gap[:-2].cumsum()[inside], minlength=len(cores))


def window_starts(n: int) -> range:
    """Starts of the windows of n words; the last one holds the last word."""
    return range(0, max(1, n - (WINDOW - STRIDE)), STRIDE)


def _means(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Means of runs of rows; each run has a row at least."""
    return np.add.reduceat(values, np.cumsum(counts) - counts) / counts.reshape(-1, *[1] * (values.ndim - 1))


def _sigmoid(x):
    return 0.5 + 0.5 * np.tanh(0.5 * x)


@dataclass
class Network:
    p: dict[str, np.ndarray] = field(default_factory=dict)
    slope: float = 1.0
    offset: float = 0.0

    @classmethod
    def fresh(cls, seed: int = 11) -> Network:
        r = np.random.default_rng(seed)
        n = lambda *shape: r.normal(0, 1 / np.sqrt(shape[0]), shape)
        p = {"word": r.normal(0, 0.05, (WORD_BUCKETS, DIM)), "char": r.normal(0, 0.05, (CHAR_BUCKETS, DIM)),
             "att": n(2 * HIDDEN, ATTENTION), "att_b": np.zeros(ATTENTION), "att_v": n(ATTENTION),
             "out": n(2 * HIDDEN), "out_b": np.zeros(1)}
        for d in "fb":
            p |= {f"W{d}": n(2 * DIM, 3 * HIDDEN), f"U{d}": n(HIDDEN, 3 * HIDDEN), f"b{d}": np.zeros(3 * HIDDEN)}
        return cls({k: v.astype(np.float32) for k, v in p.items()})

    def inputs(self, word_ids: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Vectors of words: their own, and the mean of their trigrams'."""
        own, chars = self.p["word"][word_ids], self.p["char"][grams]
        return np.concatenate([own, _means(chars, counts).astype(own.dtype)], axis=1)

    def direction(self, d: str, gates: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States [T, B, H]; ``gates`` [T, B, 3H] is what the words add, and
        padding leaves the state as it is."""
        u, h = self.p[f"U{d}"], np.zeros((gates.shape[1], HIDDEN), gates.dtype)
        out = np.empty((*gates.shape[:2], HIDDEN), gates.dtype)
        for t in range(len(gates)) if d == "f" else reversed(range(len(gates))):
            hu = h @ u
            zr = _sigmoid(gates[t, :, :2 * HIDDEN] + hu[:, :2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(gates[t, :, 2 * HIDDEN:] + r * hu[:, 2 * HIDDEN:])
            step = (1 - z) * (n - h)
            step *= mask[t][:, None]
            if keep is not None:
                keep.append((t, h, z, r, n, hu[:, 2 * HIDDEN:]))
            h = out[t] = h + step
        return out

    def pool(self, states: np.ndarray, mask: np.ndarray):
        """Attention-weighted mean of the states of the words that are there."""
        key = np.tanh(states @ self.p["att"] + self.p["att_b"])
        weight = np.exp(key @ self.p["att_v"]) * mask
        weight /= weight.sum(axis=0) + np.float32(1e-9)
        return np.einsum("tb,tbh->bh", weight, states), weight, key

    def logits(self, projected: np.ndarray, index: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Of windows: ``index`` [T, B] into rows of ``projected`` [words, 6H]."""
        states = np.concatenate([self.direction(d, projected[index, i * 3 * HIDDEN:(i + 1) * 3 * HIDDEN], mask)
                                 for i, d in enumerate("fb")], axis=2)
        return self.pool(states, mask)[0] @ self.p["out"] + self.p["out_b"][0]

    def projected(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([x @ self.p[f"W{d}"] + self.p[f"b{d}"] for d in "fb"], axis=1)

    def gradients(self, x: np.ndarray, index: np.ndarray, mask: np.ndarray, y: np.ndarray):
        """(loss, gradients of the parameters, of the words' inputs ``x``) for
        windows with labels y; back-propagation through time."""
        p, g, H = self.p, {}, HIDDEN
        keep = {d: [] for d in "fb"}
        proj = self.projected(x)
        states = np.concatenate([self.direction(d, proj[index, i * 3 * H:(i + 1) * 3 * H], mask, keep[d])
                                 for i, d in enumerate("fb")], axis=2)
        pooled, weight, key = self.pool(states, mask)
        logit = pooled @ p["out"] + p["out_b"][0]
        q = _sigmoid(logit)
        loss = float(np.mean(np.logaddexp(0, logit) - y * logit))
        dl = ((q - y) / len(y)).astype(logit.dtype)
        g["out"], g["out_b"] = pooled.T @ dl, np.array([dl.sum()])
        dpool = dl[:, None] * p["out"]
        dstates = weight[:, :, None] * dpool
        dw = np.einsum("tbh,bh->tb", states, dpool)
        ds = weight * (dw - (weight * dw).sum(axis=0))
        g["att_v"] = np.einsum("tb,tbk->k", ds, key)
        dkey = ds[:, :, None] * p["att_v"] * (1 - key * key)
        g["att"], g["att_b"] = np.einsum("tbh,tbk->hk", states, dkey), dkey.sum(axis=(0, 1))
        dstates = dstates + dkey @ p["att"].T
        dproj = np.zeros_like(proj)
        for i, d in enumerate("fb"):
            dh, gu, u = np.zeros((len(y), H), x.dtype), np.zeros_like(p[f"U{d}"]), p[f"U{d}"]
            for t, h, z, r, n, hn in reversed(keep[d]):
                dh = dh + dstates[t, :, i * H:(i + 1) * H]
                m = mask[t][:, None]
                dn = dh * m * (1 - z) * (1 - n * n)
                dz = dh * m * (h - n) * z * (1 - z)
                dr = dn * hn * r * (1 - r)
                dgate = np.concatenate([dz, dr, dn], axis=1)
                dhu = np.concatenate([dz, dr, dn * r], axis=1)
                gu += h.T @ dhu
                np.add.at(dproj[:, i * 3 * H:(i + 1) * 3 * H], index[t], dgate)
                dh = dh * (1 - m * (1 - z)) + dhu @ u.T
            own = dproj[:, i * 3 * H:(i + 1) * 3 * H]
            g[f"U{d}"], g[f"W{d}"], g[f"b{d}"] = gu, x.T @ own, own.sum(axis=0)
        dx = sum(dproj[:, i * 3 * H:(i + 1) * 3 * H] @ p[f"W{d}"].T for i, d in enumerate("fb"))
        return loss, g, dx


def windows_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, mask), both [T, windows], of a text's word numbers."""
    starts = np.array(window_starts(len(ids)))
    at = starts[None, :] + np.arange(WINDOW)[:, None]
    mask = at < len(ids)
    return (ids[np.minimum(at, len(ids) - 1)] if len(ids) else np.zeros(at.shape, np.int64)), mask.astype(np.float32)


class Scorer:
    """Logits of texts.  Holds the gate inputs of the words met, bounded."""

    def __init__(self, net: Network):
        self.net = net
        self.rows = np.zeros((1, 6 * HIDDEN), np.float32)
        self.known: dict[str, int] = {}

    def _number(self, texts_words: list[list[str]]) -> list[np.ndarray]:
        """Rows of the words' gate inputs.  Words beyond CACHED_WORDS have
        theirs behind the others, for this batch only."""
        known = self.known
        new = [w for w in dict.fromkeys(chain.from_iterable(texts_words)) if w not in known]
        at = len(known)
        if at + len(new) > len(self.rows):
            self.rows = np.concatenate([self.rows[:at], np.empty((2 * len(new), 6 * HIDDEN), np.float32)])
        for s in range(0, len(new), 8192):
            part = new[s:s + 8192]
            self.rows[at + s:at + s + len(part)] = self.net.projected(self.net.inputs(*inputs_of(part)))
        known.update(zip(new, range(at, at + len(new)), strict=True))
        out = [np.fromiter(map(known.__getitem__, words), np.int64, len(words)) for words in texts_words]
        for w in new[max(0, CACHED_WORDS - at):]:
            del known[w]
        return out

    def __call__(self, batch: list[str | None]) -> np.ndarray:
        """The highest logit of each text's windows."""
        index, mask, owner = [], [], []
        for k, ids in enumerate(self._number([words_of(t) for t in batch])):
            i, m = windows_of(ids)
            index.append(i)
            mask.append(m)
            owner.append(np.full(i.shape[1], k))
        index, mask, owner = np.concatenate(index, axis=1), np.concatenate(mask, axis=1), np.concatenate(owner)
        out = np.full(len(batch), -np.inf)
        for s in range(0, len(owner), WINDOWS_AT_ONCE):
            e = slice(s, s + WINDOWS_AT_ONCE)
            np.maximum.at(out, owner[e], self.net.logits(self.rows, index[:, e], mask[:, e]))
        return out


def score_of(net: Network, logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(net.slope * logit + net.offset, -30, 30)))


def _log_ratio(rows: list[np.ndarray], y: np.ndarray, size: int) -> np.ndarray:
    """Log ratio of the classes' shares of documents that have each bucket,
    smaller the fewer they are."""
    n = np.zeros((2, size))
    for r, label in zip(rows, y, strict=True):
        n[int(label), np.unique(r)] += 1
    up, down = (n[1] + 0.5) / (y.sum() + 1), (n[0] + 0.5) / (len(y) - y.sum() + 1)
    return np.clip(np.log(up / down), -3, 3) * np.minimum(1, n.sum(axis=0) / FULL_TRUST)


def fit(documents: list[str], label: np.ndarray, steps: int = STEPS) -> Network:
    label = np.asarray(label, dtype=np.int64)
    net = Network.fresh()
    if len(set(label.tolist())) < 2:
        share = (label.sum() + 1) / (len(label) + 2) if len(label) else 0.5
        net.slope, net.offset = 0.0, float(np.log(share / (1 - share)))
        return net
    split = [words_of(t) for t in documents]
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(split)))} or {"-": 0}
    word_ids, grams, counts = inputs_of(list(vocabulary))
    chars = np.split(grams, np.cumsum(counts)[:-1])
    numbers = [np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words)) for words in split]
    aside = np.arange(len(split)) % CALIBRATE_EVERY == 0
    if len(set(label[aside].tolist())) < 2 or len(set(label[~aside].tolist())) < 2:
        aside[:] = False
    own = np.flatnonzero(~aside)
    no = np.zeros(0, np.int64)
    doc_words = {i: word_ids[np.unique(numbers[i])] for i in own}
    doc_chars = {i: np.unique(np.concatenate([no, *[chars[k] for k in np.unique(numbers[i])]])) for i in own}

    def ratios(docs):
        return (_log_ratio([doc_words[i] for i in docs], label[docs], WORD_BUCKETS),
                _log_ratio([doc_chars[i] for i in docs], label[docs], CHAR_BUCKETS))

    # While training, a document's ratios are those of the other folds, so
    # that it isn't judged by what it has taught.
    fold_of = np.arange(len(split)) % FOLDS
    other = [ratios(own[fold_of[own] != f]) for f in range(FOLDS)]
    word_ratio, char_ratio = (np.array([x[i] for x in other], np.float32) for i in (0, 1))
    for name, ratio, has in (("word", ratios(own)[0], doc_words), ("char", ratios(own)[1], doc_chars)):
        common = np.bincount(np.concatenate([np.unique(v) for v in has.values()]), minlength=len(ratio)) >= MIN_DOCS
        net.p[name] *= common[:, None]  # the vectors of rare buckets stay zero but for the ratio
        net.p[name][:, 0] = ratio
    learn = {k: np.ones_like(v) for k, v in net.p.items()}
    for name in ("word", "char"):
        learn[name] = VECTOR_RATE * (net.p[name] != 0).astype(np.float32)
        learn[name][:, 0] = 0
    parts = [windows_of(n) for n in numbers]
    r = np.random.default_rng(13)
    up, down = own[label[own] == 1], own[label[own] == 0]
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    for step in range(1, steps + 1):
        docs = np.concatenate([r.choice(up, BATCH // 2), r.choice(down, BATCH // 2)])
        y = label[docs].astype(np.float32)
        index = np.concatenate([parts[i][0] + len(vocabulary) * fold_of[i] for i in docs], axis=1)
        mask = np.concatenate([parts[i][1] for i in docs], axis=1)
        distinct, index = np.unique(index, return_inverse=True)
        index = index.reshape(mask.shape)
        word, fold = distinct % len(vocabulary), distinct // len(vocabulary)
        own_grams, own_counts = np.concatenate([chars[k] for k in word]), counts[word]
        x = net.inputs(word_ids[word], own_grams, own_counts)
        x[:, 0] = word_ratio[fold, word_ids[word]]
        x[:, DIM] = _means(char_ratio[np.repeat(fold, own_counts), own_grams], own_counts)
        ends = np.cumsum([parts[i][1].shape[1] for i in docs])
        logit = net.logits(net.projected(x), index, mask)
        top = np.array([s + logit[s:e].argmax() for s, e in zip([0, *ends[:-1]], ends, strict=True)])
        _, g, dx = net.gradients(x, index[:, top], mask[:, top], y)
        g["word"], g["char"] = np.zeros_like(net.p["word"]), np.zeros_like(net.p["char"])
        np.add.at(g["word"], word_ids[word], dx[:, :DIM])
        np.add.at(g["char"], own_grams, np.repeat(dx[:, DIM:] / own_counts[:, None], own_counts, axis=0))
        for k, v in net.p.items():  # Adam
            m, grad = moment[k], g[k]
            m[0] = 0.9 * m[0] + 0.1 * grad
            m[1] = 0.99 * m[1] + 0.01 * grad**2
            rate = RATE * (1 - step / (steps + 1)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-6)
            net.p[k] = (v - learn[k] * rate * m[0] / (1 - 0.9**step)).astype(np.float32)
    judged = np.flatnonzero(aside) if aside.any() else own
    net.slope, net.offset = logistic_curve(Scorer(net)([documents[i] for i in judged]), label[judged])
    return net


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> Network:
    """The network; the driver gets the texts of the bounded sample only."""
    sample = labelled(docs, labels, "toxic", learn, TRAIN_ROWS)
    runs = F.split(F.coalesce("text", F.lit("")), r"\s+")
    # At least as many words as the network sees: runs, and the pieces of long ones.
    pieces = lambda w: F.size(F.split(w, BREAKS + "+")) + F.ceil(F.length(w) / (PIECE - 2))
    size = F.size(runs) + F.aggregate(F.filter(runs, lambda w: F.length(w) > LONG_RUN), F.lit(0).cast("long"),
                                      lambda n, w: n + pieces(w))
    # Both limits keep TRAIN_POSITIVES + TRAIN_NEGATIVES short texts.
    got = []
    for label, n in ((1, TRAIN_POSITIVES), (0, TRAIN_NEGATIVES)):
        got += (sample.filter((F.col("label") == label) & (size <= TRAIN_WORDS))
                .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(n).collect())
    got.sort(key=lambda r: (xxhash.xxh3_64_intdigest(str(r["doc_id"])), r["label"], r["text"] or ""))
    return fit([r["text"] for r in got], np.array([r["label"] for r in got]))


def scored(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a fixed number of parameters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for s in range(0, batch.num_rows, 500):
                part = batch.slice(s, 500)
                score = score_of(scorer.net, scorer(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, parts: int = 3, part: int = 1, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    aside = held_out(F.col("doc_id"), parts, part)
    return scored(docs, train(docs, labels, ~aside)).select(
        "doc_id", aside.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
