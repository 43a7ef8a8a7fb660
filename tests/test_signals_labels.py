"""Further signals (X1-X3), fuzzy labels (T2) and components."""

import datetime as dt
import math
import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from risingtide.operators import graph, labels, signals
from risingtide.params import DRIVER_PARAMS, ScreenParams
from risingtide.plans import catalog

SF = "/root/testdata/sf0.001"
BARS = "symbol string, date date, close double, n_ticks long"


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def history(spark):
    """A long, a sparse, a short and a one-bar history, with zero and missing
    closes, a bar without a date and one without a symbol."""
    r = random.Random(3)
    day = dt.date(2015, 1, 1)
    rows = [("long", day + dt.timedelta(days=i), r.uniform(1, 9), r.randrange(0, 50)) for i in range(700)]
    rows += [("sparse", day + dt.timedelta(days=97 * i), r.uniform(1, 9), r.randrange(1, 50)) for i in range(45)]
    rows += [("holes", day + dt.timedelta(days=i), [None, 0.0, 2.0, 0.0, 3.0][i % 5], i) for i in range(60)]
    rows += [("zeros", day + dt.timedelta(days=i), 1.0, 0) for i in range(25)]
    rows += [("one", day, 5.0, 7), ("undated", None, 1.0, 2), ("undated", day, 2.0, 4), (None, day, 1.0, 1)]
    r.shuffle(rows)
    return spark.createDataFrame(rows, BARS)


def by_symbol(df):
    out = defaultdict(list)
    for row in df.collect():
        if row["symbol"] is not None:
            out[row["symbol"]].append(row)
    return {k: sorted(v, key=lambda x: (x["date"] is not None, x["date"] or dt.date.min)) for k, v in out.items()}


CUTS = [{}, {"block_rows": 20, "chunk_days": 7}, {"block_rows": 33, "chunk_days": 400}]


@pytest.mark.parametrize("cut", CUTS)
def test_volume_spike_against_plain_lists(history, cut):
    got = by_symbol(signals.volume_spike(history, **cut))
    for symbol, rows in by_symbol(history).items():
        assert len(got[symbol]) == len(rows)
        for i, (row, bar) in enumerate(zip(got[symbol], rows, strict=True)):
            before = [x["n_ticks"] for x in rows[max(0, i - 20):i]]
            mean = sum(before) / len(before) if before else None
            ratio = bar["n_ticks"] / mean if mean else None
            assert (row["avg_ticks"], row["volume_ratio"], row["is_spike"]) == (mean, ratio, ratio is not None and ratio >= 2)


@pytest.mark.parametrize("cut", CUTS)
def test_volatility_against_plain_lists(history, cut):
    got = by_symbol(signals.volatility(history, **cut))
    for symbol, rows in by_symbol(history).items():
        changes = [None]
        for a, b in zip(rows, rows[1:], strict=False):
            a, b = a["close"], b["close"]
            if a is None or b is None or a == b == 0:
                changes.append(None)
            else:
                changes.append((b / a - 1) * 100 if a else math.copysign(math.inf, b))
        assert [r["percent"] for r in got[symbol]] == changes
        for i, row in enumerate(got[symbol]):
            frame = [x for x in changes[max(0, i - 19):i + 1] if x is not None and math.isfinite(x)]
            assert row["n_returns"] == len(frame)
            if len(frame) < 2:
                assert row["volatility"] is None
            else:
                assert row["volatility"] == pytest.approx(statistics.stdev(frame), rel=1e-12, abs=1e-12)


def test_volatility_does_not_cancel(spark):
    """Changes of which the squares are 1e16 times their spread."""
    closes = [1.0]
    for i in range(30):
        closes.append(closes[-1] * (1e6 + i % 3 * 1e-3))
    closes = [c if math.isfinite(c) else None for c in closes]
    rows = [("s", dt.date(2020, 1, 1) + dt.timedelta(days=i), c, 1) for i, c in enumerate(closes)]
    last = by_symbol(signals.volatility(spark.createDataFrame(rows, BARS)))["s"][20]
    changes = [(b / a - 1) * 100 for a, b in zip(closes, closes[1:21], strict=False)]
    assert last["volatility"] == pytest.approx(statistics.stdev(changes), rel=1e-6)


def test_cut_histories_equal_uncut_ones(history):
    """Block by block to the last digit, and no window over a whole symbol
    but that of the chunk counts."""
    for signal in (signals.volume_spike, signals.volatility):
        whole = sorted(map(repr, signal(history, block_rows=10_000, chunk_days=100_000).collect()))
        assert sorted(map(repr, signal(history, block_rows=21, chunk_days=3).collect())) == whole
    with pytest.raises(ValueError):
        signals.volume_spike(history, block_rows=19)
    plan = plan_of(signals.volatility(history))
    assert "hashpartitioning(symbol" in plan and "_block" in plan
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan


def test_signals_of_nothing(spark):
    none = spark.createDataFrame([], BARS)
    for df in (signals.volume_spike(none), signals.volatility(none), signals.relative_strength(none, DRIVER_PARAMS)):
        assert df.collect() == []


def test_relative_strength_by_hand(spark):
    d = lambda i: dt.date(2024, 1, i)
    p = ScreenParams(end_date=d(20), window_days=4)
    rows = [("a", d(20), 12.0, 1), ("a", d(16), 10.0, 1), ("a", d(15), 8.0, 1), ("b", d(17), 10.0, 1), ("b", d(19), 9.0, 1),
            ("z", d(18), 0.0, 1), ("z", d(19), 1.0, 1), ("n", d(16), None, 1), ("n", d(20), 3.0, 1), ("old", d(1), 1.0, 1),
            ("new", d(21), 1.0, 1), (None, d(20), 1.0, 1)]
    got = {(r["window_end"], r["symbol"]): r for r in signals.relative_strength(spark.createDataFrame(rows, BARS), p, 3, 2).collect()}
    last = {s: got[d(20), s] for s in "abzn"}
    assert len(got) == 4 + 3  # windows 16-20 and 13-17
    assert last["a"]["start_end_percent"] == 20.0 and last["b"]["start_end_percent"] == -10.0
    assert {r["universe_mean"] for r in last.values()} == {5.0}  # of a and b
    assert (last["a"]["relative_strength"], last["b"]["relative_strength"]) == (15.0, -15.0)
    assert last["z"]["relative_strength"] == math.inf and last["n"]["relative_strength"] is None
    assert got[d(17), "a"]["start_end_percent"] == 25.0
    assert got[d(17), "b"]["universe_mean"] == 12.5  # a: 25, b: 0 (one bar)


def test_relative_strength_plan(spark):
    """The mean comes back by a broadcast join on the window, no task sees a
    window whole and nothing is paired."""
    plan = plan_of(catalog.QUERIES["relative_strength"](spark, SF))
    assert "BroadcastHashJoin" in plan or "SortMergeJoin" in plan
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window ", "SinglePartition"):
        assert bad not in plan


# ---------------------------------------------------------------- components, fuzzy labels

def test_components_against_union_find(spark):
    r = random.Random(1)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(200)]
    edges += [(5000, 5001 + i) for i in range(150)] + [(9, 9), (7000, 7000)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {x["node"]: x["root"] for x in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root}
    assert graph.components(spark.createDataFrame([], "u string, v string")).collect() == []


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_map(words, min_length):
    counts, keys = defaultdict(int), {}
    for w in words:
        if w is not None:
            counts[w] += 1
            keys[w] = " ".join(w.strip().lower().split()).replace(" - ", "-").replace("- ", "-").replace(" -", "-")
    group = {k: k for k in keys.values()}
    long = [k for k in group if len(k) >= min_length]
    changed = True
    while changed:
        changed = False
        for a in long:
            for b in long:
                if group[a] < group[b] and one_edit(a, b):
                    group = {k: group[a] if g == group[b] else g for k, g in group.items()}
                    changed = True
    best = {}
    for w, k in keys.items():
        best[group[k]] = min(best.get(group[k], (0, "")), (-counts[w], w))
    return {(w, best[group[k]][1], counts[w]) for w, k in keys.items()}


@pytest.mark.parametrize("min_length", [4, 12])
def test_fuzzy_labels_against_all_pairs(spark, min_length):
    r = random.Random(4)
    stems = ["Semiconductors", "Clean Energy", "E - commerce", "Künstliche Intelligenz", "Banks", "Bonds", "Cybersecurity"]
    words = [None, "", "  ", "a", "b"]
    for s in stems:
        for _ in range(14):
            w = s
            for _ in range(r.randrange(3)):
                i = r.randrange(len(w))
                w = r.choice([w[:i] + w[i + 1:], w[:i] + r.choice("xyü ") + w[i:], w[:i] + r.choice("abs") + w[i + 1:]])
            words += [r.choice([w, w.upper(), f" {w} "])] * r.randrange(1, 5)
    df = spark.createDataFrame([(w,) for w in words], "core_focus string")
    got = {tuple(x) for x in labels.fuzzy_label_map(df, min_length=min_length).collect()}
    assert got == brute_map(words, min_length)
    plain = {tuple(x) for x in labels.canonical_label_map(df).collect()}
    assert len({x[1] for x in got}) < len({x[1] for x in plain})


def test_fuzzy_labels_of_a_hot_remainder(spark):
    """Many labels that differ in one place: links grow with the labels, not
    with their pairs, and no plan pairs labels."""
    n = 1500
    df = spark.createDataFrame([(f"Sector {chr(0x4E00 + i)} of markets",) for i in range(n)], "core_focus string")
    keys = df.select(F.lower("core_focus").alias("key"))
    assert labels.key_links(keys).count() == n - 1
    assert labels.fuzzy_label_map(df).select("canonical_label").distinct().count() == 1
    plan = plan_of(labels.key_links(keys))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_canonicalize_with_fuzzy_labels(spark):
    df = spark.createDataFrame([(1, "Semiconductors"), (2, "Semiconductor"), (3, "semiconductors "), (4, None), (5, "Banks")],
                               "symbol long, core_focus string")
    df = df.unionByName(spark.createDataFrame([(6, "Semiconductors")], df.schema))
    got = {r["symbol"]: r["core_focus"] for r in labels.canonicalize(df, fuzzy=True).collect()}
    assert got == {1: "Semiconductors", 2: "Semiconductors", 3: "Semiconductors", 4: None, 5: "Banks", 6: "Semiconductors"}
    assert {r["core_focus"] for r in labels.canonicalize(df).collect()} == {"Semiconductors", "Semiconductor", None, "Banks"}
