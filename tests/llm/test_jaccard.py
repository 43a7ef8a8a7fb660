"""The Jaccard join against all pairs, with sizes that make regions split."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from llm.conftest import DOC_SCHEMA, rows_of
from risingtide.llm import jaccard_join as jj

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute_force(rows):
    """doc_id, n_shingles, component_id by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            inter = len(a & sets[j])
            if inter and 100 * inter >= 75 * len(a | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = root(i)
        least[r] = min((x for x in (least.get(r), doc) if x is not None), default=None)
    return sorted(((doc, len(s), least[root(i)]) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows_of(df)), key=repr)


def corpus(seed, n=250):
    """Families of near copies (some chained at the edge of the radius),
    exact copies, shared passages and unrelated texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(3))
    passage = [word() for _ in range(60)]
    texts = []
    while len(texts) < n:
        base = [word() for _ in range(r.choice([3, 8, 30, 60, 120, 300]))]
        kind = r.random()
        if kind < 0.3:
            texts.append(" ".join(base))
        elif kind < 0.5:
            at = r.randrange(len(base) + 1)
            texts.append(" ".join(base[:at] + passage + base[at:]))
        else:
            own = list(base)
            for _ in range(r.randrange(2, 14)):
                if kind < 0.8:
                    own = list(base)  # else a chain: each copy changes the last
                for _ in range(r.randrange(0, max(2, len(base) // 25))):
                    own[r.randrange(len(own))] = word()
                texts.append(" ".join(own).upper() if r.random() < 0.1 else " ".join(own))
    return [(i * 7 % 1009, t) for i, t in enumerate(texts)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOC_SCHEMA)


def test_against_all_pairs(spark):
    rows = corpus(1)
    assert result(jj.join(frame(spark, rows).repartition(3))) == brute_force(rows)


def test_split_regions(spark, monkeypatch):
    """Regions over several tasks and rests over several chunks."""
    monkeypatch.setattr(jj, "REGION_PART", 3)
    monkeypatch.setattr(jj, "CHUNK", 2)
    rows = corpus(3, 120)
    assert result(jj.join(frame(spark, rows).repartition(3))) == brute_force(rows)


def test_without_order(spark, monkeypatch):
    """A sketch that says nothing changes no link."""
    monkeypatch.setattr(jj, "_sketch", lambda sets: np.zeros(jj.SKETCH, np.int32))
    rows = corpus(4, 100)
    assert result(jj.join(frame(spark, rows))) == brute_force(rows)


def test_edge_rows(spark, edge_docs, no_docs):
    docs = edge_docs.withColumn("k1", F.lit("x")).withColumn("part", F.lit(1)).withColumn("n", F.lit(0))
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert result(jj.join(docs)) == brute_force(rows)
    assert jj.join(no_docs).collect() == []


def test_keep_first(spark, edge_docs, no_docs):
    rows = [*corpus(5, 100), (3, "one two three"), (3, "one two three"), (3, "other words here"), (1, None), (1, None)]
    docs = frame(spark, rows).withColumn("_k", F.lit(1))
    kept = rows_of(jj.keep_first(docs))
    assert set(kept[0]) == set(docs.columns)
    want, seen = brute_force(rows), set()
    component = {}
    for i, s, c in want:
        component.setdefault((i, s), set()).add(c)
    for r in kept:
        s = shingle_set(r["text"])
        assert not s or r["doc_id"] in component[r["doc_id"], len(s)]
        seen.add((r["doc_id"], s))
    groups = {}  # one row for each group with words, all rows without
    sets = [shingle_set(t) for _, t in rows]
    for i, s in enumerate(sets):
        if s:
            own = {j for j, o in enumerate(sets) if o and 100 * len(s & o) >= 75 * len(s | o)}
            groups[i] = own
    roots = list(range(len(rows)))

    def root(i):
        while roots[i] != i:
            i = roots[i]
        return i

    for i, own in groups.items():
        for j in own:
            a, b = root(i), root(j)
            roots[max(a, b)] = min(a, b)
    assert len(kept) == len({root(i) for i in groups}) + sum(not s for s in sets)
    assert jj.keep_first(no_docs).collect() == []
    assert len(rows_of(jj.keep_first(edge_docs))) == len(
        {c for _, n, c in brute_force([(r["doc_id"], r["text"]) for r in edge_docs.collect()]) if n}) + 3


def test_embedding_never_lowers_an_intersection():
    r = np.random.default_rng(0)
    for n in (1, 5, 50, 700, 5000):
        a = np.unique(r.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[: n // 2], r.integers(0, 2**63, n, dtype=np.uint64)]))
        top = jj.most_common(jj._counts(jj.embedding(a).tobytes()), jj._counts(jj.embedding(b).tobytes()))
        assert top >= jj.common(a, b)
    same = np.arange(40_000, dtype=np.uint64)  # one range holds them all
    c = jj._counts(jj.embedding(same).tobytes())
    assert jj.most_common(c, c) >= 40_000


def test_open_regions_over_batches():
    """Any cut of the sorted rows into batches gives the same regions."""
    r = np.random.default_rng(1)
    a = np.sort(r.integers(0, 12, 200))
    m = r.integers(2, 40, 200)
    order = np.lexsort((m, a))
    a, m, x = a[order], m[order], r.permutation(200)
    whole = jj.open_regions(a, m, x, (None, 0, 0))
    for _ in range(20):
        cuts = [0, *sorted(r.choice(np.arange(1, 200), 5, replace=False)), 200]
        carry, pivots, kept = (None, 0, 0), [], []
        for s, e in zip(cuts, cuts[1:], strict=False):
            p, k, carry = jj.open_regions(a[s:e], m[s:e], x[s:e], carry)
            pivots.append(p)
            kept.append(k)
        kept = np.concatenate(kept)
        assert (kept == whole[1]).all()
        assert (np.concatenate(pivots)[kept] == whole[0][kept]).all()


def test_rest_pairs_against_all_pairs():
    """No pair that may link is missed, in one level or two."""
    r = np.random.default_rng(5)
    base = r.integers(0, 2**64, 400, dtype=np.uint64)
    sets = []
    for _ in range(60):
        own = base[r.random(400) < r.choice([0.8, 0.95])][:r.integers(200, 400)]
        sets.append(np.unique(np.concatenate([own, r.integers(0, 2**64, r.integers(0, 120), dtype=np.uint64)])))
    n = np.array([len(s) for s in sets])
    raw = [jj.embedding(s).tobytes() for s in sets]
    near = np.arange(60) < 10
    root, chunk = np.arange(60), np.zeros(60, int)
    d, exact = np.zeros(60), np.zeros(60, bool)
    links = {(i, j) for i in range(60) for j in range(i)
             if jj.linked(jj.common(sets[i], sets[j]), n[i], n[j]) and not (near[i] and near[j])}
    assert links
    _, pairs = jj.rest_pairs(near, chunk, root, d, exact, n, raw, False, True)
    assert links <= {(max(p), min(p)) for p in pairs}
    for i, j in pairs:
        assert jj.least_distance(jj._counts(raw[i]), jj._counts(raw[j]), n[i], n[j]) <= jj.RADIUS + 1e-6
    pivots, first = jj.rest_pairs(near, chunk, root, d, exact, n, raw, False, False)
    left = np.array([i for i in range(60) if i not in set(pivots)])
    _, second = jj.rest_pairs(near[left], chunk[left], root[left], d[left], exact[left], n[left], [raw[i] for i in left], False, True)
    both = {(max(p), min(p)) for p in first} | {(max(left[a], left[b]), min(left[a], left[b])) for a, b in second}
    assert links <= both
    full = [jj.embedding(np.arange(n, dtype=np.uint64)).tobytes() for n in (1000, 1100)]  # one range holds them all
    two = jj.Embedded(full, np.array([1000, 1100]))
    assert two.may_link(0, np.array([False, True])).tolist() == [1]
