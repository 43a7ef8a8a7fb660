"""Quality rules, sharding, WARC packages and top-k search."""

import base64
import hashlib
import io
import struct
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from llm.conftest import rows_of
from oracle_check import compare, duck
from risingtide.llm import oracle, quality_rules, queries, sharding, vector_topk, warc_zip
from risingtide.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_matches_oracle(spark, con, name):
    res = compare(queries.QUERIES[name](spark, SF), con, oracle.SQL[name], exact=True)
    assert res["match"], res


# ------------------------------------------------------------ quality rules

def brute_measures(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return {"n_words": len(words), "word_chars": sum(map(len, words)),
            "n_symbols": sum(c in "#*$%&|<>" for c in text or ""), "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": len(covered)}


def test_measures_against_brute_force(spark, edge_docs, no_docs):
    extra = spark.createDataFrame(
        [(20, "a b c d e a b c d e f", "xx", "q"), (21, "a\na\n \n\nb\na", "xx", "q"), (22, "w " * 60, "xx", "q"),
         (23, "# * $ % & | < > #x é𝔘 \x0b\x0c\r end", "xx", "q"), (24, "a b c d e a b c d e a b c d e x y", None, "q")],
        "doc_id long, text string, lang string, source string")
    docs = edge_docs.unionByName(extra, allowMissingColumns=True).withColumn("n_words", F.lit("clash"))
    out = rows_of(quality_rules.judge(docs))
    by_id = defaultdict(list)
    for r in out:
        by_id[r["doc_id"]].append(r)
    for r in docs.collect():
        want = brute_measures(r["text"])
        got = by_id[r["doc_id"]][0]
        assert {k: got[k] for k in want} == want, r["doc_id"]
        assert got["base_failed"] == (want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"])
        assert not (got["base_failed"] and got["kept"])
    assert len(out) == docs.count()
    assert quality_rules.judge(no_docs).collect() == []


def test_adaptive_fences_follow_the_group(spark):
    """The same share of symbols is normal in one source and not in another."""
    rows = []
    for i in range(60):
        words = [f"word{(i * 37 + k) % 997}" for k in range(40)]
        rows.append((i, " ".join(words), "en", "prose"))
        code = [w + ("#" if k % 2 else "") + "$" for k, w in enumerate(words)]
        rows.append((100 + i, " ".join(code), "en", "code"))
    rows.append((999, rows[1][1], "en", "prose"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in rows_of(quality_rules.judge(docs))}
    assert not kept.pop(999) and all(kept.values())
    assert {r["doc_id"] for r in rows_of(quality_rules.keep(docs))} == set(kept)


def test_fences_follow_the_spread_of_the_group(spark):
    """A share of distinct words that one source spreads over is off in
    another, and a few symbols are where there are none."""
    def doc(i, fresh, sign=""):
        words = ["and" if k % 2 and k // 2 < 40 - fresh else f"w{i}x{k}" for k in range(40)]
        return " ".join(w + sign * (k % 5 == 0) for k, w in enumerate(words))

    rows = [(i, doc(i, 39 + i % 2), "en", "even") for i in range(40)]
    rows += [(100 + i, doc(i, 20 + i % 20), "en", "wide") for i in range(40)]
    rows += [(900, doc(900, 24), "en", "even"), (901, doc(901, 24), "en", "wide"), (902, doc(902, 40, "#"), "en", "even")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = rows_of(quality_rules.judge(docs))
    assert not any(r["base_failed"] for r in out)
    assert {r["doc_id"] for r in out if not r["kept"]} == {900, 902}


def test_small_groups_take_wider_fences(spark):
    """Junk in a source of few documents, or of a language of few, is judged
    by the language or by all documents; a group that junk fills a quarter of
    still finds it."""
    def doc(i, junk=False):
        return " ".join(f"w{i}x{k}" + "#*$" * junk for k in range(40))

    rows = [(i, doc(i), "en", "big") for i in range(90)] + [(500 + i, doc(500 + i, i % 4 == 0), "en", "mixed") for i in range(80)]
    rows += [(900, doc(900, True), "en", "rare"), (901, doc(901), "en", "rare"), (902, doc(902, True), "xx", None), (903, doc(903), "xx", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    gone = {r["doc_id"] for r in rows_of(quality_rules.judge(docs)) if not r["kept"]}
    assert gone == {900, 902} | {500 + i for i in range(0, 80, 4)}


def test_groups_decide_and_good_documents_stay(spark):
    """On the labelled documents the groups' own quantiles, not the least
    distances, set the fences of most groups, and labels agree."""
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    sketch = quality_rules.sketches(quality_rules._measured(docs.select("doc_id", "text", "lang", "source")))
    own = quality_rules.fences(sketch, ["lang"]).collect()
    middle = {(r["lang"], r["measure"]): r["q50"] for r in sketch.groupBy("lang", "measure", "bin").agg(F.sum("n").alias("n")).withColumn(
        "half", F.sum("n").over(Window.partitionBy("lang", "measure")) / 2).withColumn(
        "seen", F.sum("n").over(Window.partitionBy("lang", "measure").orderBy("bin"))).where("seen >= half").groupBy("lang", "measure").agg(
        F.min(quality_rules.bin_floor(F.col("bin"))).alias("q50")).collect()}
    for measure in ("symbols", "chars"):
        wider = [r[f"hi_{measure}"] - middle[r["lang"], measure] > quality_rules.MEASURES[measure].least for r in own]
        assert sum(wider) > len(wider) / 2, measure
    judged = quality_rules.judge(docs).where("not base_failed").join(labels, "doc_id")
    kept = {r["quality"]: r["share"] for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[1] >= 0.99 and kept[0] <= 0.1


def test_bins_are_close_and_ordered(spark):
    x = [*range(2000), 10**6, 10**9, 2**40]
    df = spark.createDataFrame([(v,) for v in x], "x long").withColumn("b", quality_rules.bin_of(F.col("x")))
    out = df.withColumn("lo", quality_rules.bin_floor(F.col("b"))).orderBy("x").collect()
    assert all(r["lo"] <= r["x"] <= r["lo"] * (1 + 2**-quality_rules.SUB) for r in out)
    assert [r["b"] for r in out] == sorted(r["b"] for r in out)


def test_rules_plan_has_no_python(spark):
    plan = quality_rules.judge(table(spark, SF, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ------------------------------------------------------------ sharding

@pytest.mark.parametrize("n", [1, 2, 3, 24, 1000, 4321])
def test_feistel_is_a_permutation(n):
    f = sharding.FeistelShuffle(n, 5)
    p = f.position(np.arange(n))
    assert sorted(p) == list(range(n)) and (f.row(p) == np.arange(n)).all()
    shard, slot = sharding.locate(n, 7, np.arange(n), 5)
    assert (sharding.row_at(n, 7, shard, slot, 5) == np.arange(n)).all()


def test_feistel_of_large_tables():
    n = 10**13 + 7
    f, x = sharding.FeistelShuffle(n, 1), np.random.default_rng(0).integers(0, n, 10_000)
    p = f.position(x)
    assert (f.row(p) == x).all() and p.max() < n and abs(p.mean() / n - 0.5) < 0.02


def test_shards(spark, edge_docs, no_docs, monkeypatch):
    docs = edge_docs.unionByName(edge_docs).withColumn("shard", F.lit("x"))
    a = rows_of(sharding.shard(docs, 5, seed=3))
    assert len(a) == docs.count()
    slots = defaultdict(list)
    for r in a:
        slots[r["shard"]].append(r["slot"])
        shard, slot = sharding.locate(len(a), 5, r["row_number"], 3)
        assert (shard[0], slot[0]) == (r["shard"], r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode()))
                   for r in docs.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in a) == want
    key = lambda r: tuple(map(repr, r.values()))
    monkeypatch.setattr(sharding, "COPY_RUN", 1)
    b = rows_of(sharding.shard(docs.repartition(7), 5, seed=3))
    assert sorted(a, key=key) == sorted(b, key=key)  # however the rows are dealt
    assert sharding.shard(no_docs, 5).collect() == []


# ------------------------------------------------------------ WARC packages

PAGES = "page_id long, url string, html string, refers_to string"


def test_packages_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc_zip, "PACKAGE_RECORDS", 3)
    rows = [(1, "u1", "same"), (2, "u2\r\nX: y", "same"), (5, None, "same"), (3, "u3", None), (4, "u4", ""),
            (6, "u6", "é" * 200_000), (7, "u7", "WARC/1.1\r\n\r\nbody"), (7, "u7", "WARC/1.1\r\n\r\nbody"),
            (None, "n", "no id"), (None, "n", "same")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], PAGES).repartition(2)
    out = rows_of(warc_zip.round_trip(spark, pages))
    top = defaultdict(lambda: None)
    for i, _, t in rows:
        if i is not None:
            top[t or ""] = max(i, top[t or ""] or i)
    want = Counter()
    for i, _, t in rows:
        body = (t or "").encode()
        revisit = top[t or ""] is not None and i != top[t or ""]
        want[(i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
              "revisit" if revisit else "response", top[t or ""] if revisit else None)] += 1
    assert Counter(tuple(r.values()) for r in out) == want
    assert warc_zip.round_trip(spark, spark.createDataFrame([], PAGES)).collect() == []


def zip_of(members, comment=b"", prefix=b""):
    buf = io.BytesIO(prefix)
    buf.seek(len(prefix))
    with zipfile.ZipFile(buf, "a" if prefix else "w", zipfile.ZIP_STORED) as z:
        for name, data in members.items():
            z.writestr(name, data)
        z.comment = comment
    return buf.getvalue()


def reader(raw):
    return (lambda offset, n: raw[offset:offset + n]), len(raw)


def test_directory_with_comment_and_many_members():
    raw = zip_of({f"m{i}": f"data {i}".encode() for i in range(70_000)}, comment=b"PK\x05\x06 odd comment")
    read, size = reader(raw)  # more members than 16 bits count: ZIP64
    found = warc_zip.members(read, size)
    assert len(found) == 70_000
    for i in (0, 1, 69_999):
        at, n = warc_zip.stored_member(read, found[f"m{i}"])
        assert raw[at:at + n] == f"data {i}".encode()


def test_zip64_extra_fields():
    """A member whose sizes and offset are in the ZIP64 extra field."""
    name, data = b"big", b"payload"
    local = struct.pack("<4s5H3I2H", b"PK\x03\x04", 45, 0, 0, 0, 0, zlib.crc32(data), 0xFFFFFFFF, 0xFFFFFFFF, 3, 20)
    local += name + struct.pack("<HHQQ", 1, 16, len(data), len(data)) + data
    extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), 0)
    central = struct.pack("<4s6H3I5H2I", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, zlib.crc32(data), 0xFFFFFFFF, 0xFFFFFFFF,
                          3, len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    end64 = struct.pack("<4sQ2H2I4Q", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(central), len(local))
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, len(local) + len(central), 1)
    end = struct.pack("<4s4H2IH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    raw = local + central + end64 + locator + end
    read, size = reader(raw)
    at, n = warc_zip.stored_member(read, warc_zip.members(read, size)["big"])
    assert raw[at:at + n] == data


def test_damaged_packages_are_refused():
    with pytest.raises(ValueError):
        warc_zip.members(*reader(b"no zip here" * 10))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"x" * 100)
    read, size = reader(buf.getvalue())
    with pytest.raises(ValueError):
        warc_zip.stored_member(read, warc_zip.members(read, size)["a"])


# ------------------------------------------------------------ top-k search

def brute_topk(rows, k, every):
    own = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            own.setdefault((i, tuple(int(np.floor(256 * np.float64(np.float32(x)))) for x in v)))
    out = []
    for i, v in own:
        if i % every == 0:
            best = sorted({(-sum(a * b for a, b in zip(v, w, strict=True)), j)
                           for j, w in own if j != i and len(w) == len(v)})[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out)


def test_topk_against_brute_force(spark):
    r = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in r.normal(size=17)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(60)]  # many equal vectors
    rows += [(400, None), (401, [None] * 17), (402, [float("nan")] * 17), (403, [float("inf")] * 17), (None, rows[0][1]),
             (404, [1.0, 2.0]), (405, [3.0, 1.0]), (406, []), (450, [0.5, 0.5]), (rows[3][0], rows[3][1]), (500, rows[7][1])]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, score string")
    want = brute_topk(rows, 5, 50)
    for blocks in ({}, {"query_block": 3, "candidate_block": 40}):
        got = sorted(tuple(x.values()) for x in rows_of(vector_topk.topk(df, 5, 50, **blocks)))
        assert got == want
    assert vector_topk.topk(df.limit(0), 5, 50).collect() == []


def test_topk_of_wide_components(spark):
    """Components far beyond any embedding's, scored exactly as long as a long
    holds the score; rows that repeat one id with many vectors."""
    rows = [(0, [1.0, 0.0]), (1, [9e6, 0.0]), (2, [1e7, 0.0]), (3, [1e9, -3.0]), (4, [-1e9, 1.0]), (50, [1e9, 2.5]), (6, [0.25, 1.0])]
    rows += [(7, [float(i), 0.5]) for i in range(200)] + [(100, [1e300, 0.0]), (8, [-1e300, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    own = {(i, tuple(int(np.floor(256 * x)) if abs(x) < 1e15 else int(x * 256) for x in v)) for i, v in rows}
    want = set()
    for i in (0, 50, 100):
        v = next(v for j, v in own if j == i)
        best = sorted({(-min(max(sum(a * b for a, b in zip(v, w, strict=True)), -2**63), 2**63 - 1), j) for j, w in own if j != i})[:5]
        want |= {(i, r, j, -s) for r, (s, j) in enumerate(best, 1)}
    for blocks in ({}, {"query_block": 1, "candidate_block": 16}):
        assert {tuple(x.values()) for x in rows_of(vector_topk.topk(df, 5, 50, **blocks))} == want


def test_bounds_are_never_below_the_product():
    r = np.random.default_rng(4)
    a, b = r.integers(-500, 500, (40, 33)), r.integers(-500, 500, (40, 33))
    b[:5] = a[:5]
    exact = a @ b.T
    last = None
    for starts in vector_topk.segment_bounds(33):
        bound = np.hstack(vector_topk.segment_statistics(a, starts)) @ np.hstack(vector_topk.segment_statistics(b, starts)).T
        assert (bound >= exact - 1e-6 * np.abs(bound).max()).all()
        if last is not None:
            assert bound.mean() <= last  # finer is closer
        last = bound.mean()


@pytest.mark.parametrize("size", [3, 500, 2**27])
def test_block_search_on_ties_and_large_components(size):
    """Small values give many ties, large ones products beyond a double's digits."""
    r = np.random.default_rng(size)
    c = r.integers(-size, size, (300, 24))
    c[50:90] = c[7]
    ids = r.permutation(1000)[:300]
    out = vector_topk.search(ids[::10], c[::10].astype(float), ids, c.astype(float), 5)
    for row, i in enumerate(ids[::10]):
        best = sorted((-int(c[10 * row] @ c[j]), int(ids[j])) for j in range(300) if ids[j] != i)[:5]
        got = out[out.query_id == i]
        assert sorted(zip(-got.score, got.vec_id, strict=True)) == best
