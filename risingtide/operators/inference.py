"""Batch inference (U1, U2, A10, A11, S7): the model calls of the reference,
as Spark operators with an injected predictor.

The reference put *every* symbol into one prompt and made one call per
sector.  Neither scales: here records are cut into bounded batches
(``bounded_batches``), each batch is one call, and the calls run inside
Python workers fed by Arrow, in an iterator over a partition's sorted rows
(``mapInPandas``).  The reply is free text; cutting out and parsing the JSON array is done JVM-side
with built-in functions (``functions.text.parse_json_rows``), and replies
that do not parse go to a reject frame instead of failing the job.

A predictor is ``predict(records: list[dict]) -> str``.  The default one is
a deterministic keyword rule, so runs need no network.  A real model client
would retry its own transient errors; Spark re-runs a failed task.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from risingtide.functions.text import parse_json_rows
from risingtide.session import broadcast_hint, checked_broadcast, materialize, materialize_measured

Predictor = Callable[[list[dict]], str]

REPLY_SCHEMA = "batch_key string, n_records int, reply string"
SECTOR_ELEMENT = "symbol bigint, core_focus string"
FACTS_ELEMENT = ("core_focus string, core_focus_overview string, "
                 "is_core_focus_future_potential boolean, "
                 "core_focus_future_potential_overview string")

_WORD = re.compile(r"[^\W\d_]{4,}")


def keyword_sector_predict(records: list[dict]) -> str:
    """Default classifier: the sector of a record is the most frequent word
    of four or more letters in its whole text, lower-cased, ties to the
    alphabetically smallest (``"other"`` if none).  Returns a model-like
    reply with the JSON array inside free text."""
    out = []
    for r in records:
        counts = Counter(w.lower() for w in _WORD.findall(str(r.get("text") or "")))
        label = min(counts.items(), key=lambda kv: (-kv[1], kv[0]))[0] if counts else "other"
        out.append({"symbol": r["symbol"], "core_focus": label})
    return "Here is the result:\n" + json.dumps(out, ensure_ascii=False) + "\nDone."


def describe_sectors_predict(records: list[dict]) -> str:
    """Default sector describer: fixed sentences per sector; every sector is
    flagged as having future potential."""
    out = [{"core_focus": r["core_focus"],
            "core_focus_overview": f"Companies whose main business is {r['core_focus']}",
            "is_core_focus_future_potential": True,
            "core_focus_future_potential_overview": f"{r['core_focus']} keeps growing"}
           for r in records]
    return json.dumps(out, ensure_ascii=False)


def _dealt(df: DataFrame, key: str, max_rows: int, groups: list[str]) -> DataFrame:
    """``df`` with ``_bucket`` and the record's 128-bit digest ``_d1``,
    ``_d2``.  Buckets hold about ``max_rows`` rows.  Which bucket a record is
    in depends on the records alone, not on splits, tasks or the size of the
    cluster, and no text has been moved yet:

    1. rows are counted by group (no text is read), and by digest, which finds
       the records that have more copies than a batch holds;
    2. ``bucket = pmod(digest, ceil(n / max_rows))`` spreads a group over
       buckets, and so a hot group or a key repeated in many rows;
    3. a record of too many copies is reduced to one row and a count (a partial
       aggregate) and dealt out again, one bucket for every ``max_rows``
       copies.

    ``df`` is read up to three times: pass a materialised frame when it is
    costly to compute.
    """
    record = [key] + [c for c in df.columns if c != key and c not in groups]
    rows = df.withColumns({"_d1": F.xxhash64(*record), "_d2": F.xxhash64(F.lit(1), *record)})
    heavy, n_heavy, size = materialize_measured(
        rows.groupBy(*groups, "_d1", "_d2").agg(F.count(F.lit(1)).alias("_copies")).where(F.col("_copies") > max_rows)
        .select(*[F.col(g).alias(f"_h_{g}") for g in groups], F.col("_d1").alias("_h1"), F.col("_d2").alias("_h2")))
    digest = ["_d1", "_d2"]
    if n_heavy:
        same = reduce(lambda x, y: x & y, [F.col(g).eqNullSafe(F.col(f"_h_{g}")) for g in groups]
                      + [(F.col("_d1") == F.col("_h1")) & (F.col("_d2") == F.col("_h2"))])
        heavy = broadcast_hint(heavy, n_heavy, size)
        once = rows.join(heavy, same, "left_semi").groupBy(*groups, *record, *digest).agg(F.count(F.lit(1)).alias("_copies"))
        part = F.explode(F.expr(f"sequence(0L, _copies - 1, {max_rows}L)"))
        copy = F.explode(F.expr(f"sequence(_part, least(_part + {max_rows}L, _copies) - 1)"))
        copies = (once.withColumn("_part", part).withColumn("_copy", copy)
                  .withColumn("_bucket", -1 - F.pmod(F.xxhash64(*digest, "_part"), F.lit(2**62)))
                  .select(*df.columns, *digest, "_bucket"))
        rows = rows.join(heavy, same, "left_anti")
    if groups:
        counts = checked_broadcast(df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
                                   .withColumnsRenamed({g: f"_g_{g}" for g in groups}))
        rows = rows.join(counts, reduce(lambda x, y: x & y, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups]))
        n = F.col("_n")
    else:
        n = F.lit(df.count())
    buckets = F.greatest(F.lit(1), F.ceil(n / F.lit(max_rows))).cast("long")
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*digest), buckets)).select(*df.columns, *digest, "_bucket")
    return rows.unionByName(copies) if n_heavy else rows


def bounded_batches(df: DataFrame, key: str, max_rows: int,
                    group_cols: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Adds ``batch_bucket``, ``batch_id`` and ``batch_row`` so that no
    (group, batch) holds more than ``max_rows`` rows, without a global sort
    and without a window over a whole group (see ``_dealt``).  Rows are
    numbered inside a bucket by key and digest; ``batch = (bucket, number div
    max_rows)`` caps every batch at exactly ``max_rows``.

    Texts are shuffled once, by bucket; grouping the result by
    ``batch_bucket`` and ``batch_id`` needs no further Exchange.
    """
    groups = list(group_cols)
    w = Window.partitionBy(*groups, "_bucket").orderBy(key, "_d1", "_d2")
    return (_dealt(df, key, max_rows, groups).withColumn("_rn", F.row_number().over(w) - 1)
            .withColumn("batch_id", F.concat_ws(":", F.col("_bucket").cast("string"),
                                                F.expr(f"_rn div {max_rows}").cast("string")))
            .withColumn("batch_row", (F.col("_rn") % max_rows).cast("int"))
            .select(*df.columns, F.col("_bucket").alias("batch_bucket"), "batch_id", "batch_row"))


def _called(df: DataFrame, key: str, max_records: int, groups: list[str], answer: Callable[[list[dict]], str]) -> DataFrame:
    """One ``answer`` per batch, cut inside the partition: the rows of a bucket
    come as a sorted stream of Arrow batches, and an iterator holds one batch
    of records at a time.  Texts are shuffled once, by bucket."""
    cols, at = df.columns, [*groups, "_bucket"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, number, records = None, 0, []

        def reply() -> dict:
            return {"batch_key": f"{place}:{number}", "n_records": len(records), "reply": answer(records)}

        for pdf in frames:
            out = []
            for here, record in zip(pdf["_place"], pdf[cols].to_dict("records"), strict=True):
                if here != place or len(records) == max_records:
                    if records:
                        out.append(reply())
                    number = number + 1 if here == place else 0
                    place, records = here, []
                records.append(record)
            yield pd.DataFrame(out, columns=["batch_key", "n_records", "reply"])
        if records:
            yield pd.DataFrame([reply()])

    # A group's name is told apart from the others' and from a NULL.
    place = F.concat_ws(":", *([F.to_json(F.struct(*groups))] if groups else []), F.col("_bucket").cast("string"))
    dealt = _dealt(df, key, max_records, groups).withColumn("_place", place)
    return dealt.repartition(*at).sortWithinPartitions(*at, key, "_d1", "_d2").mapInPandas(run, REPLY_SCHEMA)


def prompt_documents(df: DataFrame, batch_cols: list[str], record_cols: list[str],
                     order_col: str) -> DataFrame:
    """One JSON document per batch -- the records of the batch as a JSON
    array ordered by ``order_col``.  Batches are bounded upstream, so each
    collected list is bounded.  Grouped by the batch's bucket too, if the
    frame has it, the rows stay where ``bounded_batches`` has put them."""
    bucket = [c for c in ("batch_bucket",) if c in df.columns and c not in batch_cols]
    # array_sort orders structs by their first field
    rec = F.struct(*[F.col(c) for c in [order_col] + [c for c in record_cols if c != order_col]])
    return (df.groupBy(*bucket, *batch_cols)
            .agg(F.count(F.lit(1)).alias("n_records"),
                 F.to_json(F.array_sort(F.collect_list(rec))).alias("document")).drop(*bucket))


MAX_RECORDS_PER_CALL = 100
# Fixed value: attempts per model call (the reference asked again when a
# reply held no parsable JSON array, up to 3 times).
MODEL_ATTEMPTS = 3


def _not_json(constant):
    raise ValueError(f"{constant} is not JSON")


def reply_has_array(text) -> bool:
    """Whether the span from the first ``[`` to the last ``]`` of a reply is
    one JSON array of objects: the rule of ``functions.text.parse_json_rows``
    (which decides what becomes a row), for the call that may be repeated."""
    if not isinstance(text, str):
        return False
    start, end = text.find("["), text.rfind("]")
    if start < 0 or end < start:
        return False
    try:
        items = json.loads(text[start:end + 1], parse_constant=_not_json)
    except ValueError:
        return False
    return isinstance(items, list) and all(isinstance(x, dict) for x in items)


def call_model(df: DataFrame, predict: Predictor, key: str,
               max_records: int = MAX_RECORDS_PER_CALL,
               attempts: int = MODEL_ATTEMPTS) -> DataFrame:
    """One ``predict`` call per batch of records, inside Python workers.

    Batches are those of ``bounded_batches``: the same records share a call
    whatever the splits, ``max_records`` alone sets how many calls there are
    (and so how far they spread).  A call whose reply holds no JSON array, or
    that raises, is made again, up to ``attempts`` times; the last unparsable
    reply is kept (it ends in the reject frame of ``parse_replies``), the
    last error fails the task.  Output: ``(batch_key, n_records, reply)``,
    lazy -- ``model_replies`` calls once and keeps the replies.
    """

    def answer(records: list[dict]) -> str | None:
        text = None
        for attempt in range(1, attempts + 1):
            try:
                text = predict(records)
            except Exception:
                if attempt == attempts:
                    raise
                continue
            if reply_has_array(text):
                break
        return text

    return _called(df, key, max_records, [], answer)


def model_replies(df: DataFrame, predict: Predictor, key: str, **kw) -> DataFrame:
    """``call_model`` with the replies materialised: rows, rejects and counts
    that are read from them come from the same calls."""
    return materialize(call_model(df, predict, key, **kw))


def parse_replies(replies: DataFrame, element_ddl: str, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """J1 + S4: ``(rows, rejects)`` -- parsed reply elements, one row each,
    and the replies that gave less than that, with ``reason`` and ``n_lost``
    elements: no parsable JSON array, or (with ``key``) elements whose key is
    missing or of another type."""
    parsed = replies.withColumn("_items", parse_json_rows(F.col("reply"), element_ddl))
    valid = F.filter("_items", lambda x: F.lit(True) if key is None else x[key].isNotNull())
    parsed = parsed.withColumn("_valid", valid)
    rows = parsed.where(F.col("_items").isNotNull()).select(F.inline("_valid"))
    n_lost = F.when(F.col("_items").isNull(), F.col("n_records") if "n_records" in replies.columns
                    else F.lit(None).cast("int")).otherwise(F.size("_items") - F.size("_valid"))
    rejects = (parsed.withColumn("n_lost", n_lost.cast("int"))
               .withColumn("reason", F.when(F.col("_items").isNull(), F.lit("no JSON array of objects"))
                           .otherwise(F.lit("element without a valid key")))
               .where(F.col("_items").isNull() | (F.col("n_lost") > 0)).drop("_items", "_valid"))
    return rows, rejects


def classify(df: DataFrame, predict: Predictor | None = None, key: str = "symbol", text: str = "text",
             **kw) -> tuple[DataFrame, DataFrame]:
    """U1 + S7 + J1: ``(symbol, core_focus)`` per input record, plus rejects,
    both from the same materialised replies.  The reply's symbol is parsed
    with the key's own type (ticker text or a numeric id)."""
    raw = df.select(F.col(key).alias("symbol"), F.col(text).alias("text"))
    element = f"symbol {df.schema[key].dataType.simpleString()}, core_focus string"
    return parse_replies(model_replies(raw, predict or keyword_sector_predict, "symbol", **kw), element, "symbol")


def describe_sectors(shared: DataFrame, predict: Predictor | None = None, **kw) -> tuple[DataFrame, DataFrame]:
    """U1 for the second call: facts per shared sector, bounded batches of
    sectors per call; rows and rejects from the same materialised replies."""
    replies = model_replies(shared.select("core_focus"), predict or describe_sectors_predict, "core_focus", **kw)
    return parse_replies(replies, FACTS_ELEMENT, "core_focus")


def translate_per_group(df: DataFrame, group_col: str, key: str, cols: list[str], predict: Predictor,
                        max_rows: int = 200, attempts: int = MODEL_ATTEMPTS) -> tuple[DataFrame, DataFrame]:
    """One translation call per group (in bounded batches, so
    a hot group is split), answered with text that is parsed like any reply:
    ``(rows, rejects)`` with the translated ``cols`` under ``<col>_local``.
    A reply that can't be parsed is asked for again; its last form is kept in
    the rejects with its group and batch."""
    names = [key, group_col, *cols]

    def answer(records: list[dict]) -> str | None:
        text = None
        for _ in range(attempts):
            text = predict(records)
            if reply_has_array(text):
                break
        return text

    replies = materialize(_called(df.select(*names), key, max_rows, [group_col], answer))
    key_type = df.schema[key].dataType.simpleString()
    element = ", ".join([f"{key} {key_type}", f"{group_col} string", *[f"{c}_local string" for c in cols]])
    return parse_replies(replies, element, key)


def apply_per_group(df: DataFrame, group_col: str, key: str, fn: Callable[[pd.DataFrame], pd.DataFrame],
                    schema: str, max_rows: int = 200) -> DataFrame:
    """``fn`` on the rows of each group (e.g. translate one sector's
    rows in one call), in bounded batches so a hot group is split over
    several calls and tasks."""
    b = bounded_batches(df, key, max_rows, [group_col])
    out_cols = [f.split()[0] for f in schema.split(",")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return fn(pdf.drop(columns=["batch_bucket", "batch_id", "batch_row"]))[out_cols]

    return b.groupBy(group_col, "batch_bucket", "batch_id").applyInPandas(run, schema)
