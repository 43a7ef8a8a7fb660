"""Spelling variants, conversation repair and embedding near-duplicates."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle_check import compare, duck
from risingtide.llm import conversation_repair, oracle, pivot_permutation, variant_words
from risingtide.llm.common import table

SF = "/root/testdata/sf0.001"

# ------------------------------------------------------------ spelling variants


def brute_words(rows, every):
    counts = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if every and h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    return counts


def brute_variants(rows, every, ratio=5):
    words = {w: n for w, n in brute_words(rows, every).items() if len(w) >= 6 and n >= 5}
    letters = set("".join(words))

    def near(w):
        out = {w[:i] + w[i + 1:] for i in range(len(w))}
        out |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        out |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
        return (out - {w}) & words.keys()

    form, result = {}, set()
    for w, n in words.items():
        best = min(near(w), key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= ratio * n else None
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        result.add((w, form[w], root, n, len(near(w)), words.get(form[w])))
    return result


def variant_rows(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.fixture(scope="module")
def spelled(spark):
    """Words one, two and three edits apart, of many counts, with accents,
    repeated letters, prefixes and very long ones."""
    rnd = random.Random(5)
    stems = ["q" * 90 + "banana" * 20, "banana", "anbana", "aaaaaa", "aaaaaaa", "abcdefgh", "émigré", "emigre", "interestingly", "x" * 300, "Straßenbahn"]
    words = set(stems)
    for w in stems:
        for _ in range(12):
            v = w
            for _ in range(rnd.choice([1, 1, 2])):
                i, c = rnd.randrange(len(v) + 1), rnd.choice("abxéÿ×")
                v = rnd.choice([v[:i] + c + v[i:], v[:i] + v[i + 1:], v[:i] + c + v[i + 1:]])
            words.add(v)
    text = [w for w in sorted(words) for _ in range(rnd.choice([4, 5, 6, 30, 200, 1100]))]
    rnd.shuffle(text)
    rows = [(i, " 1-".join(text[at:at + 50]), "en", i, "w") for i, at in enumerate(range(0, len(text), 50))]
    rows += [(None, "banana BANANA", None, 0, ""), (7, None, None, 0, ""), (8, "", None, 0, ""), (8, " \n", None, 0, "")]
    return spark.createDataFrame(rows, "doc_id long, text string, word string, n long, list string")


@pytest.mark.parametrize("every, prune, part", [(0, 100, 20_000), (7, 3, 20_000), (199, 10, 4)])
def test_variants_against_brute_force(spelled, every, prune, part):
    rows = [tuple(r) for r in spelled.select("doc_id", "text").collect()]
    got = variant_rows(variant_words.variants(spelled, every, prune=prune, list_part=part))
    want = brute_variants(rows, every)
    assert got == want
    assert sum(r[4] for r in want) > 50 and len({r[2] for r in want}) < len(want)


def test_variants_on_edge_documents(edge_docs, no_docs):
    assert variant_rows(variant_words.variants(no_docs)) == set()
    rows = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    assert variant_rows(variant_words.variants(edge_docs, 3)) == brute_variants(rows, 3)


def test_frequent_grams_are_bounded(spark):
    words = spark.createDataFrame([(f"{a}{b}{a}{b}xyz",) for a in "abcdefgh" for b in "abcdefgh"], "word string")
    grams = variant_words.frequent_grams(words, 64 * 7, prune=1, dictionary=10)
    assert grams and all(n > 64 * 7 // 10 for n in grams.values())
    per_length = Counter(map(len, grams))
    assert max(per_length.values()) <= 10


def test_very_long_words_of_one_list():
    """Words of 40,000 code points that differ in one, at any place, and one
    that differs in two: pairs without as many remainders as code points."""
    base = "ab" * 20_000
    same = [base, *(base[:i] + "x" + base[i + 1:] for i in (0, 19_999, 20_000, 39_999)), "x" + base[1:-1] + "x"]
    rows = [(w, 7, variant_words.SAME, 0, len(w)) for w in same]
    got = {(a, b) for a, _, b, _ in variant_words.list_pairs(rows)}
    assert got == {(a, b) for a in same for b in same if a < b and variant_words.near(a, b)} and len(got) == 6
    longer = [base[:i] + c + base[i:] for i, c in ((0, "y"), (7, "a"), (20_000, "y"), (40_000, "b"))]
    rows = [(base, 7, variant_words.SHORTER, 0, len(base))] + [(w, 5, variant_words.LONGER, 0, len(w)) for w in [*longer, "y" + base[:-1] + "y"]]
    assert {b if a == base else a for a, _, b, _ in variant_words.list_pairs(rows)} == set(longer)


def test_affected_bound_covers_every_edit():
    """No edit changes more grams of a word than its bound."""
    rnd = random.Random(2)
    frequent = {g: 9 for g in ("ab", "ba", "aba", "bab", "abab", "aa", "aab", "xa")}
    for _ in range(300):
        w = "".join(rnd.choice("abx") for _ in range(rnd.randrange(6, 14)))
        longest = len(w) // 2
        own = variant_words.decompose(w, longest, frequent)
        i, c = rnd.randrange(len(w)), rnd.choice("abx")
        for role, v in ((0, w[:i] + c + w[i + 1:]), (1, w[:i] + c + w[i:])):
            other = variant_words.decompose(v, longest, frequent)
            left = {(p, e) for p, e in other}
            right = {(p - len(v), e - len(v)) for p, e in other}
            lost = sum((p, e) not in left and (p - len(w), e - len(w)) not in right for p, e in own)
            assert lost <= variant_words.affected(own, len(w), role)


# --------------------------------------------------------- conversation repair


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h:
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            out += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def brute_repair(rows):
    """Shortest path over (row, state), ties by the edits' initials."""
    seen, faults = set(), []
    for _, role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if text.rstrip(" \t\n\x0b\x0c\r")[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            break
        if (i, state) in done:
            continue
        done.add((i, state))
        to = follows[state]
        heapq.heappush(heap, (cost + 3, audit + "I", i, to, (*out, name[to] + ":")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, out))
            if faults[i] in ("", "truncated"):
                stays = 3 if faults[i] else 0
                if role[:1] == to or (state == "" and role[:1] == "s"):
                    heapq.heappush(heap, (cost + stays, audit + "K", i + 1, role[:1], (*out, f"{role}:{text}")))
                heapq.heappush(heap, (cost + stays + 3, audit + "R", i + 1, to, (*out, f"{name[to]}:{text}")))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *map(faults.count, ("blank", "duplicate", "truncated")),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False)),
            cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def check_repair(df, **kw):
    by_id = defaultdict(list)
    for r in df.select("conv_id", "turn", "role", "text").collect():
        by_id[r["conv_id"]].append(tuple(r))
    got = {r["conv_id"]: tuple(r)[1:] for r in conversation_repair.repair(conversation_repair.damaged(df), **kw).collect()}
    assert got == {k: brute_repair(damaged(v)) for k, v in by_id.items()}
    return got


@pytest.fixture(scope="module")
def chats(spark):
    rnd = random.Random(1)
    rows = []
    for c in range(250):
        for t in range(rnd.randrange(0, 14)):
            conv = rnd.choice([c, c, c, None]) if c < 5 else c
            rows.append((conv, rnd.choice([t, t, t, t, None, t // 2]), rnd.choice(["user", "assistant"] * 3 + ["system", "tool", "", None]),
                         rnd.choice(["a.", "b!", "c", "hi.", "", " ", None, "x.y? ", "d\t", "long " * 2000 + "."]), 1, "x", 2))
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, copies int, fault string, block int")


@pytest.mark.parametrize("buffer, rows", [(4_000_000, 20_000), (3, 1), (30, 3)])
def test_repair_against_shortest_paths(chats, buffer, rows):
    check_repair(chats, buffer=buffer, buffer_rows=rows)


def test_repair_of_a_giant_conversation_and_of_many_copies(spark):
    """Spilled blocks; copies of one row travel once and are deleted."""
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"turn {i}.") for i in range(3000)]
    rows += [(2, 5, "user", "again.")] * 500 + [(2, 6, "assistant", "yes.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = check_repair(df, buffer=2000, buffer_rows=64)
    assert len(got[1][6]) > 2800 and got[2][2] >= 499


def test_repair_of_nothing(spark):
    schema = "conv_id string, turn int, role string, text string"
    assert check_repair(spark.createDataFrame([], schema)) == {}
    lone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)  # dropped by the damage
    got = check_repair(spark.createDataFrame([(str(lone), 0, "user", "gone.")], schema))
    assert got == {str(lone): (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


# ------------------------------------------------------------------ embeddings

VECTORS = "vec_id long, embedding array<double>, label int"


def brute_links(rows, threshold=0.93):
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def vector(e):
        if not e or any(x is None or not np.isfinite(x) for x in e) or not any(e):
            return None
        return np.array(e) / max(map(abs, e))

    vectors, links = [vector(r[1]) for r in rows], [0] * len(rows)
    for i, a in enumerate(vectors):
        for j, b in enumerate(vectors[:i]):
            if a is None or b is None or len(a) != len(b) or rows[i][2] is None or rows[i][2] != rows[j][2]:
                continue
            if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], links[i], least.get(find(i)), r[0] == least.get(find(i))) for i, r in enumerate(rows)), key=repr)


def near_pairs_at(cosine, n, dim=64, seed=3):
    rng = np.random.default_rng(seed)
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    x, y = unit(rng.normal(size=(n, dim))), unit(rng.normal(size=(n, dim)))
    y = unit(y - (x * y).sum(axis=1, keepdims=True) * x)
    y = cosine * x + np.sqrt(1 - cosine**2) * y
    return [(2 * i + k, [float(f) for f in v], i % 2) for i in range(n) for k, v in enumerate((x[i], 3.0 * y[i]))]


def test_embedding_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1),
            (7, [], 1), (8, [0.0, 0.0], 1), (9, [1.0, None], 1), (10, [nan, 1.0], 1), (11, [inf, 1.0], 1), (12, [1e300, 1e290], 1),
            (13, [1e-300, 0.0], 1), (None, [0.0, 1.0], 1), (None, [0.0, 1.0], 1), (14, [1.0, 0.0, 0.0], 1), (15, [-1.0, 0.0], 1),
            (15, [-1.0, 0.0], 1), (16, [1.0, 0.1], 1), (17, [-0.0, 1.0], 3), (18, [0.0, 1.0], 3)]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], VECTORS + ", copies int, k1 string")
    got = sorted((tuple(r) for r in pivot_permutation.near_duplicates(df).collect()), key=repr)
    assert got == brute_links(rows)
    assert pivot_permutation.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [2048, 16])
def test_embedding_recall_and_precision(spark, chunk):
    """Pairs just above the threshold, where the index is weakest, and pairs
    just below it, of which none may be linked."""
    rows = near_pairs_at(0.931, 800) + [(10_000 + i, v, y) for i, v, y in near_pairs_at(0.929, 300, seed=4)]
    df = spark.createDataFrame(rows, VECTORS)
    got = {r["vec_id"]: r for r in pivot_permutation.near_duplicates(df, chunk=chunk).collect()}
    found = sum(got[i]["n_links"] for i in range(1600))
    assert found >= 0.98 * 1600
    assert all(got[i]["n_links"] <= 1 for i in got) and not any(got[i]["n_links"] for i in got if i >= 10_000)


def test_embedding_clusters_and_copies(spark):
    """A large group of near copies, and one of equal vectors: all links are
    counted, within lists that are joined chunk by chunk too."""
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=64), rng.normal(size=64)
    rows = [(i, [float(x) for x in a + 0.02 * rng.normal(size=64)], 1) for i in range(150)]
    rows += [(1000 + i, [float(x) for x in b], 1) for i in range(100)] + [(2000 + i, [float(x) for x in rng.normal(size=64)], i % 3) for i in range(80)]
    got = sorted((tuple(r) for r in pivot_permutation.near_duplicates(spark.createDataFrame(rows, VECTORS), chunk=40).collect()), key=repr)
    assert got == brute_links(rows)
    assert sum(r[1] for r in got) >= 150 * 149 + 100 * 99


def test_embedding_query_against_sql(spark, tmp_path):
    """The statement holds on a table with links, which the small tables lack."""
    rows = near_pairs_at(0.99, 60) + [(900 + i, v, 0) for i, (_, v, _) in enumerate(near_pairs_at(0.99, 2)[:1] * 5)]
    spark.createDataFrame(rows, VECTORS).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duck(SF)
    con.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    df = pivot_permutation.near_duplicates(table(spark, str(tmp_path), "embeddings"))
    assert df.agg(F.sum("n_links")).first()[0] >= 120 + 20
    res = compare(df, con, oracle.SQL["op13_embedding_dedup"], exact=True)
    assert res["match"], res
