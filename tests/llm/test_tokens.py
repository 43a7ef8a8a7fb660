"""Token histogram, packing and SentencePiece encoding against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.conftest import crc, rows_of
from risingtide.llm import packing, queries, sp_prefix, token_histogram
from risingtide.llm.byte_bpe import document_ids
from risingtide.llm.common import table, tokenizer_file

SF = "/root/testdata/sf0.001"
BPE, SP = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


def library_ids(texts):
    t = Tokenizer.from_file(BPE)
    return [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def check_packing(docs, out):
    """Every id of every document in one piece, sequences without gaps."""
    ids = Counter()
    texts = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    want = defaultdict(Counter)
    for (doc, _), own in zip(texts, library_ids([t for _, t in texts]), strict=True):
        own = [*own, 0]
        ids[doc] += len(own)
        want[doc][len(own)] += 1
        for piece in (r for r in out if r["doc_id"] == doc and r["doc_tokens"] == len(own)):
            part = own[piece["start"]:piece["start"] + piece["length"]]
            piece.setdefault("fits", False)
            piece["fits"] |= len(part) == piece["length"] and crc(part) == piece["ids_crc32"]
    assert all(r["fits"] for r in out)
    got = Counter()
    cover = defaultdict(list)
    for r in out:
        got[r["doc_id"]] += r["length"]
        cover[r["doc_id"], r["doc_tokens"]].append((r["start"], r["start"] + r["length"]))
    assert got == ids
    for (doc, n), spans in cover.items():
        edges = Counter()
        for a, b in spans:
            edges[a] += 1
            edges[b] -= 1
        copies, level = want[doc][n], 0
        for at in sorted(edges):
            level += edges[at]
            assert level == (copies if at < n else 0)
    by_sequence = defaultdict(list)
    for r in out:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    padding = 0
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    return padding, sum(ids.values())


def test_packing_holds_every_id_once(spark):
    docs = table(spark, SF, "documents")
    padding, total = check_packing(docs, rows_of(packing.pack(docs, BPE)))
    assert padding <= 0.01 * total


def test_packing_of_edge_rows(spark, edge_docs, no_docs):
    clashing = edge_docs.withColumn("rank", F.lit("x")).withColumn("length", F.lit(1)).withColumn("_b", F.lit(2))
    padding, _ = check_packing(edge_docs, rows_of(packing.pack(clashing, BPE)))
    assert padding <= 1024
    assert packing.pack(no_docs, BPE).collect() == []


def test_packing_of_many_short_documents(spark):
    """Demands large enough that most pieces go to whole patterns."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"),
                                    F.expr("repeat('word ', 1 + cast(pmod(hash(id), 700) as int))").alias("text"))
    padding, total = check_packing(docs, rows_of(packing.pack(docs, BPE)))
    assert padding <= 0.01 * total


@pytest.mark.parametrize("histogram", [{600: 1000}, {1024: 3}, {1: 5}, {}, {700: 3, 324: 10, 5: 1},
                                       {i: i % 7 + 1 for i in range(1, 1024)}])
def test_plan_places_each_rank_once(histogram):
    plan = packing.make_plan(dict(histogram))
    used = defaultdict(int)
    for n, lo, hi, per, _, _ in plan.entries.tolist():
        assert lo == used[n] and (hi - lo) % per == 0
        used[n] = hi
    for n, k in histogram.items():
        assert used[n] <= k
        if n != 1024:
            assert plan.rest[n][0] == used[n]
    left = sum((k - used[n]) * n for n, k in histogram.items())
    assert plan.rest_ids == left and (not left or plan.cuts()[-1] == left)


def test_knapsack_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(20):
        lengths = np.sort(rng.choice(np.arange(2, 20), 4, replace=False))
        values = rng.random(4)
        best = np.zeros(31)
        for c in range(1, 31):
            best[c] = max([best[c - 1], *(values[i] + best[c - n] for i, n in enumerate(lengths) if n <= c)])
        got, counts = packing.best_pattern(values, lengths, 30)
        assert got == pytest.approx(best[30]) and counts @ values == pytest.approx(best[30])
        assert counts @ lengths <= 30


def test_histogram_against_counts(spark, edge_docs, no_docs):
    docs = table(spark, SF, "documents").unionByName(edge_docs).withColumn("n_docs", F.lit(1))
    out = rows_of(token_histogram.histogram(token_histogram.encoded_lengths(docs, ["lang"], BPE), ["lang"]))
    rows = docs.select("lang", "text").collect()
    lengths = defaultdict(list)
    for r, ids in zip(rows, library_ids([r["text"] or "" for r in rows]), strict=True):
        lengths[r["lang"]].append(len(ids))
    assert {(r["lang"], r["n_tokens"]): r["n_docs"] for r in out} == {
        (k, n): c for k, v in lengths.items() for n, c in Counter(v).items()}
    for r in out:
        own = lengths[r["lang"]]
        limit = r["n_tokens"]
        assert r["docs_from"] == sum(n >= limit for n in own) and r["docs_below"] == len(own) - r["docs_from"]
        assert r["tokens_from"] == sum(n for n in own if n >= limit)
        assert r["truncated_total"] == sum(min(n, limit) for n in own)
    hist = spark.createDataFrame(out)
    for r in rows_of(token_histogram.at_limits(hist, ["lang"], [1, 100, 10_000_000])):
        own = lengths[r["lang"]]
        assert r["truncated_total"] == sum(min(n, r["limit"]) for n in own)
        assert r["docs_longer_or_equal"] == sum(n >= r["limit"] for n in own)
    for r in rows_of(token_histogram.quantile(hist, ["lang"], 0.5)):
        own = sorted(lengths[r["lang"]])
        assert r["n_tokens"] == next(n for n in own if sum(x <= n for x in own) >= 0.5 * len(own))
    empty = token_histogram.encoded_lengths(no_docs, ["lang"], BPE)
    assert token_histogram.histogram(empty, ["lang"]).collect() == []
    assert token_histogram.answers(token_histogram.histogram(empty, ["lang"]), ["lang"], [5], [0.5]).collect() == []


def test_query_answers_limits_and_quantiles(spark):
    lengths = defaultdict(list)
    rows = table(spark, SF, "documents").collect()
    for r, ids in zip(rows, library_ids([r["text"] or "" for r in rows]), strict=True):
        lengths[r["lang"]].append(len(ids))
    out = rows_of(queries.QUERIES["op4_token_counts"](spark, SF))
    kinds = Counter((r["kind"], r["lang"]) for r in out)
    for lang, own in lengths.items():
        assert (kinds["length", lang], kinds["limit", lang], kinds["quantile", lang]) == (len(set(own)), 6, 3)
    for r in out:
        own = sorted(lengths[r["lang"]])
        if r["kind"] == "limit":
            assert r["truncated_total"] == sum(min(n, r["n_tokens"]) for n in own)
            assert r["docs_from"] == sum(n >= r["n_tokens"] for n in own)
        elif r["kind"] == "quantile":
            assert r["n_tokens"] == next(n for n in own if sum(x <= n for x in own) >= r["share"] * len(own))


def test_sentencepiece_against_library(spark, edge_docs, no_docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=SP)
    docs = table(spark, SF, "documents").unionByName(edge_docs).withColumn("ids", F.lit(0))
    out = rows_of(sp_prefix.digests(sp_prefix.encode_decode(docs, SP)))
    want = []
    for r in docs.collect():
        ids = sp.encode(r["text"] or "")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append({"doc_id": r["doc_id"], "n_tokens": len(ids), "ids_sha256": sha(",".join(map(str, ids))),
                     "decoded_sha256": sha(sp.decode(ids))})
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["ids_sha256"])
    assert sorted(out, key=key) == sorted(want, key=key)
    assert sp_prefix.encode_decode(no_docs, SP).collect() == []


def test_prefix_table_on_random_texts():
    enc, sp = sp_prefix.encoder(SP), sentencepiece.SentencePieceProcessor(model_file=SP)
    rng = np.random.default_rng(5)
    odd = ["a", "b", "the", " ", "  ", "\n", "\t", "▁", "1", "é", "中", "𝔘", "😀", "\0", "<s>", "<0x41>", "ing", "²", ".", ","]
    pieces = [p for p in enc.pieces if not p.startswith("<0x")]
    for _ in range(3000):
        for pool in (odd, pieces):
            text = "".join(rng.choice(pool, rng.integers(0, 9)))
            ids = sp.encode(text)
            got, decoded = enc.encode_and_decode(text)
            assert got == ids and decoded == sp.decode(ids) == enc.decode(ids), repr(text)


def test_compatibility_walk_against_merging():
    enc = sp_prefix.encoder(SP)
    rng = np.random.default_rng(6)
    whole = sorted(enc.whole)
    for a, b in rng.choice(whole, (20_000, 2)).tolist():
        merged = enc._merged(enc.pieces[a] + enc.pieces[b])[0] == [enc.pieces[a], enc.pieces[b]]
        assert enc._compatible(a, b) == merged


def test_prefix_table_without_cuts():
    """One long table: no spaces, punctuation or unknown characters."""
    enc, sp = sp_prefix.encoder(SP), sentencepiece.SentencePieceProcessor(model_file=SP)
    text = "thequickbrownfox" * 5000
    assert enc.encode(text) == sp.encode(text)


def test_added_token_in_a_text():
    """Its string stands for its id wherever a text holds it, as in the
    library."""
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", " <|endoftext|>\n", "<|endoftext", "x" * 9 + "<|endoftext|>" * 3]
    got = [ids.tolist() for ids in document_ids(BPE, texts)]
    assert got == [[*ids, 0] for ids in library_ids(texts)]
    assert got[0] == [64, 220, 50256, 275, 0]
