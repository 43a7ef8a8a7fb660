"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query binds the driver tables to the logical tables (see
``risingtide.sources.driver``) and runs one operator or composite on the
whole tables.  No query collects; the caller decides the action.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from risingtide.operators import enrich, inference, labels, localize, momentum, report, signals
from risingtide.operators import sectors as sector_ops
from risingtide.params import DRIVER_PARAMS as P
from risingtide.plans import alert, job
from risingtide.session import checkpoint_dir, materialize
from risingtide.sources import bars, driver, listings, lookups, records, replies, sinks, store
from risingtide.streaming import daily, stateful

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- sources

@register("universe_scan")
def q_universe_scan(spark, sf):
    return driver.exchange_listing(spark, sf, "NYSE")


@register("universe_union")
def q_universe_union(spark, sf):
    return driver.universe(spark, sf)


@register("price_window_scan")
def q_price_window_scan(spark, sf):
    return driver.prices(spark, sf, P)


@register("price_scan_for_universe")
def q_price_scan_for_universe(spark, sf):
    return bars.price_scan_for_universe(driver.prices(spark, sf, P), driver.universe(spark, sf))


@register("bars_union")
def q_bars_union(spark, sf):
    """Two bar sources, the second with an extra tick-count column."""
    mid = P.start_date + _dt.timedelta(days=5)
    t = driver.ticks(spark, sf)
    first = bars.daily_bars(bars.ticks_in_window(t, P.start_date, mid))
    second = bars.daily_bars(bars.ticks_in_window(t, mid + _dt.timedelta(days=1), P.end_date), count=True)
    return bars.bars_union([first, second])


@register("parse_date")
def q_parse_date(spark, sf):
    raw = driver.table(spark, sf, "events").select(
        "event_id", F.substring(F.col("ts").cast("string"), 1, 10).alias("date"))
    return bars.parse_bar_dates(raw)


@register("fundamentals_lookup")
def q_fundamentals_lookup(spark, sf):
    per_symbol = momentum.screened_symbols(
        momentum.momentum_screen(driver.prices(spark, sf, P), P))
    return lookups.fundamentals_lookup(
        lookups.fundamentals_table(driver.fundamentals_raw(spark, sf)), per_symbol, P)


@register("cap_filter")
def q_cap_filter(spark, sf):
    return lookups.cap_filter(lookups.fundamentals_table(driver.fundamentals_raw(spark, sf)), P)


@register("json_defaults")
def q_json_defaults(spark, sf):
    raw = driver.table(spark, sf, "events").select("event_id", F.col("props").alias("body"))
    return lookups.fundamentals_from_json(raw, key="event_id", cap_path="$.k")


@register("news_top3")
def q_news_top3(spark, sf):
    return lookups.news_top(driver.news(spark, sf), P)


# ---------------------------------------------------------------- momentum

@register("pct_change")
def q_pct_change(spark, sf):
    return momentum.with_percent(momentum.clean_bars(driver.prices(spark, sf, P), P))


@register("start_end_percent")
def q_start_end_percent(spark, sf):
    return momentum.scored_bars(driver.prices(spark, sf, P), P).select(
        "symbol", "date", "close", "start_end_percent")


@register("last_values")
def q_last_values(spark, sf):
    return momentum.scored_bars(driver.prices(spark, sf, P), P).select(
        "symbol", "date", "last_price", "last_percent")


@register("up_days")
def q_up_days(spark, sf):
    return momentum.up_days(driver.prices(spark, sf, P), P)


@register("upside_counts")
def q_upside_counts(spark, sf):
    return momentum.upside_counts(driver.prices(spark, sf, P), P)


@register("repetitive_up_days")
def q_repetitive_up_days(spark, sf):
    return momentum.repetitive_up_days(driver.prices(spark, sf, P), P)


@register("momentum_screen")
def q_momentum_screen(spark, sf):
    return momentum.momentum_screen(driver.prices(spark, sf, P), P)


@register("latest_day_screen")
def q_latest_day_screen(spark, sf):
    return momentum.latest_day_screen(driver.prices(spark, sf, P), P)


@register("distinct_symbols")
def q_distinct_symbols(spark, sf):
    return momentum.momentum_screen(driver.prices(spark, sf, P), P).select("symbol").distinct()


# ---------------------------------------------------------------- further signals

def _history(spark, sf):
    """Daily bars with tick counts over all of the tick table."""
    return bars.daily_bars(driver.ticks(spark, sf), count=True)


@register("volume_spike")
def q_volume_spike(spark, sf):
    return signals.volume_spike(_history(spark, sf))


@register("volatility")
def q_volatility(spark, sf):
    return signals.volatility(_history(spark, sf))


@register("relative_strength")
def q_relative_strength(spark, sf):
    return signals.relative_strength(_history(spark, sf), P)


# ---------------------------------------------------------------- sectors / joins

def _survivor_inputs(spark, sf):
    """(per-symbol screen, cap-passing overview, measured survivor keys), all
    from one materialised survivor table."""
    surv, kept = alert.survivor_keys(
        driver.prices(spark, sf, P), lookups.fundamentals_table(driver.fundamentals_raw(spark, sf)), P)
    per_symbol = surv.select("symbol", *momentum.SCREEN_COLUMNS[1:])
    overview = surv.select("symbol", "company_overview", "marketCap")
    return per_symbol, overview, kept


def _survivor_sectors(spark, sf):
    """The survivors' sector rows, materialised: the shared-sector count and
    the join with the facts both read them, the sector table only once."""
    per_symbol, overview, kept = _survivor_inputs(spark, sf)
    sec = (driver.sectors(spark, sf).join(kept, "symbol", "left_semi")
           .select("symbol", "core_focus").distinct())
    return per_symbol, overview, materialize(sec)


@register("sector_nunique")
def q_sector_nunique(spark, sf):
    return sector_ops.sector_nunique(driver.sectors(spark, sf))


@register("shared_sectors")
def q_shared_sectors(spark, sf):
    _, _, sec = _survivor_sectors(spark, sf)
    return sector_ops.shared_sectors(sec)


@register("future_sectors")
def q_future_sectors(spark, sf):
    segs = driver.sectors(spark, sf).select("core_focus").distinct()
    return sector_ops.future_sectors(driver.sector_facts(segs))


@register("sector_join")
def q_sector_join(spark, sf):
    _, _, sec = _survivor_sectors(spark, sf)
    return sector_ops.sector_join(sec, driver.sector_facts(sector_ops.shared_sectors(sec)))


@register("news_left_join")
def q_news_left_join(spark, sf):
    _, overview, kept = _survivor_inputs(spark, sf)
    top = lookups.news_top(driver.news_source(spark, sf), P, symbols=kept)
    return enrich.news_left_join(overview, top)


@register("enriched_rows")
def q_enriched_rows(spark, sf):
    per_symbol, overview, sec = _survivor_sectors(spark, sf)
    facts = driver.sector_facts(sector_ops.shared_sectors(sec))
    return enrich.enriched_rows(sec, facts, overview, per_symbol)


@register("news_concat")
def q_news_concat(spark, sf):
    return enrich.news_per_symbol(lookups.news_top(driver.news(spark, sf), P))


@register("alert_report")
def q_alert_report(spark, sf):
    return alert.alert_report(
        driver.prices(spark, sf, P),
        lookups.fundamentals_table(driver.fundamentals_raw(spark, sf)),
        driver.sectors(spark, sf), driver.news_source(spark, sf), driver.sector_facts, P)


# ---------------------------------------------------------------- text, inference, labels

REPLY_BATCH = 100  # records per model call in the SQL-checked bindings


@register("bad_record_split")
def q_bad_record_split(spark, sf):
    ev = driver.table(spark, sf, "events").select(
        F.lit("events").alias("source"), F.col("event_id").alias("record_id"),
        F.lit(0).cast("bigint").alias("part"), F.col("props").alias("body"))
    conv = driver.table(spark, sf, "conversations").select(
        F.lit("conversations").alias("source"), F.col("conv_id").alias("record_id"),
        F.col("turn").alias("part"), F.col("text").alias("body"))
    schema = T.StructType([T.StructField("k", T.LongType())])
    return records.tag_bad_records(ev.unionByName(conv), "body", schema)


@register("classify_batches")
def q_classify_batches(spark, sf):
    docs = driver.table(spark, sf, "documents").select(
        F.col("doc_id").alias("symbol"), "text")
    rows, _ = inference.classify(docs)
    return rows


@register("prompt_batches")
def q_prompt_batches(spark, sf):
    """The records of each call's document.  Which batch a record is in
    follows from a hash, so the checked result is each batch's size bound and
    the records themselves, read back from the documents."""
    fund = lookups.cap_filter(lookups.fundamentals_table(driver.fundamentals_raw(spark, sf)), P)
    b = inference.bounded_batches(fund.select("symbol", "company_overview"), "symbol", REPLY_BATCH)
    docs = inference.prompt_documents(b, ["batch_id"], ["symbol", "company_overview"], "symbol")
    rec = F.inline(F.from_json("document", "array<struct<symbol: bigint, company_overview: string>>"))
    return docs.select((F.col("n_records") <= REPLY_BATCH).alias("within_bound"), rec)


def _sector_replies(spark, sf):
    """Model-like replies for the sector labels, one per batch of customers:
    clean ones, and by turns with text in brackets after the array, two
    arrays, an array cut off and keys of another type; plus conversation
    turns as replies that hold no array at all."""
    batch = F.floor(F.col("symbol") / REPLY_BATCH).cast("bigint")
    arr = F.concat(F.lit("["), F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("symbol", "core_focus"))),
        lambda x: F.concat(F.lit('{"symbol":'), x["symbol"].cast("string"), F.lit(',"core_focus":"'),
                           x["core_focus"], F.lit('"}'))), ","), F.lit("]"))
    by_batch = driver.sectors(spark, sf).groupBy(batch.alias("batch_id")).agg(
        F.count(F.lit(1)).cast("int").alias("n_records"), arr.alias("arr"))
    a, kind = F.col("arr"), F.col("batch_id") % 6
    half = F.substring(a, F.lit(1), F.expr("length(arr) div 2"))
    reply = (F.when(kind == 0, F.concat(F.lit("Sure. Here are the labels:\n"), a, F.lit("\nAnything else?")))
             .when(kind == 1, F.concat(a, F.lit(" Let me know [if] you need more.")))
             .when(kind == 2, F.concat(a, F.lit(" and then "), a))
             .when(kind == 3, F.concat(F.lit("Labels: "), half))
             .when(kind == 4, F.concat(F.lit("Labels: "), F.replace(a, F.lit('"symbol":'), F.lit('"symbol":"no. ","id":'))))
             .otherwise(a))
    good = by_batch.select(F.col("batch_id").cast("string").alias("batch_key"), "n_records", reply.alias("reply"))
    noise = driver.table(spark, sf, "conversations").select(
        F.concat_ws(":", "conv_id", "turn").alias("batch_key"), F.lit(1).alias("n_records"), F.col("text").alias("reply"))
    return good.unionByName(noise)


@register("extract_json_array")
def q_extract_json_array(spark, sf):
    rows, _ = inference.parse_replies(_sector_replies(spark, sf), inference.SECTOR_ELEMENT, "symbol")
    return rows


@register("reply_rejects")
def q_reply_rejects(spark, sf):
    _, rejects = inference.parse_replies(_sector_replies(spark, sf), inference.SECTOR_ELEMENT, "symbol")
    return rejects.select("batch_key", "n_records", "reason", "n_lost")


def _words(spark, sf):
    """Every word of every document (whole texts), punctuation stripped --
    one regex pass per text, then a split on blanks."""
    d = driver.table(spark, sf, "documents").select("text")
    clean = F.regexp_replace(F.col("text"), r"[.,;:!?()\"]", "")
    return (d.select(F.explode(F.split(clean, r"\s+")).alias("core_focus"))
            .where(F.col("core_focus") != ""))


@register("canonical_labels")
def q_canonical_labels(spark, sf):
    return labels.canonical_label_map(_words(spark, sf))


@register("fuzzy_labels")
def q_fuzzy_labels(spark, sf):
    return labels.fuzzy_label_map(_words(spark, sf))


@register("label_quality")
def q_label_quality(spark, sf):
    c = driver.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return labels.label_quality(c, "text").select("conv_id", "turn", "n_words", "within_limit")


# ---------------------------------------------------------------- report

def _alert(spark, sf):
    """The alert rows, materialised: the report queries read them twice
    (sector sections and stock items) and they are one row per stock."""
    return materialize(q_alert_report(spark, sf))


@register("localize_report")
def q_localize_report(spark, sf):
    cols = ["core_focus", "core_focus_overview", "core_focus_future_potential_overview", "company_overview", "news_data"]
    rows = _alert(spark, sf).select("symbol", "news_source", *cols)
    return localize.localize_with_map(rows, {c: f"{c}_local" for c in cols}, localize.HEBREW)


def _translator(records):
    """Stand-in for the translation model: answers with text around a JSON
    array, as a model does."""
    import json

    table = dict(localize.HEBREW)
    out = [{"symbol": r["symbol"], "core_focus": r["core_focus"],
            "core_focus_local": table.get(r["core_focus"], r["core_focus"]),
            "news_data_local": "***".join(table.get(x, x) for x in r["news_data"].split("***"))} for r in records]
    return "Here you go:\n" + json.dumps(out, ensure_ascii=False) + "\nDone"


@register("translate_groups")
def q_translate_groups(spark, sf):
    # the model gets its group as a column of its own, under another name
    rows = _alert(spark, sf).select("symbol", "core_focus", "news_data")
    out, _ = inference.translate_per_group(rows, "core_focus", "symbol", ["news_data"], _translator)
    names = localize.localize_with_map(out.select("symbol", "core_focus"), {"core_focus": "core_focus_local"}, localize.HEBREW)
    return out.join(names, ["symbol", "core_focus"]).select("symbol", "core_focus", "core_focus_local", "news_data_local")


@register("report_sections")
def q_report_sections(spark, sf):
    return report.report_sections(_alert(spark, sf), P.end_date)


@register("report_items")
def q_report_items(spark, sf):
    return report.report_items(_alert(spark, sf))


@register("report_html")
def q_report_html(spark, sf):
    return report.report_fragments(_alert(spark, sf), P.end_date)


@register("report_document")
def q_report_document(spark, sf):
    return report.report_document(_alert(spark, sf), P.end_date)


def _scratch(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}/{uuid.uuid4().hex}"


@register("report_write")
def q_report_write(spark, sf):
    path = _scratch(spark, "reports")
    sinks.write_report(report.report_fragments(_alert(spark, sf), P.end_date), path, P.end_date)
    return sinks.read_report(spark, path)


@register("html_document")
def q_html_document(spark, sf):
    """The document as HTML part files with a manifest, read back by it."""
    path = _scratch(spark, "documents")
    sinks.write_document(report.html_document(report.report_document(_alert(spark, sf), P.end_date)), path, P.end_date)
    return sinks.read_document(spark, path, P.end_date)


@register("run_status")
def q_run_status(spark, sf):
    return sinks.run_status(spark, _alert(spark, sf), P.end_date)


# ---------------------------------------------------------------- error paths of the job

def _job(spark, sf, out, params=P, sectors=None, facts_for=driver.sector_facts, attempts=1):
    """One run of the daily flow on the bound tables, some part replaced."""
    return job.run_flow(spark, out, params, lambda trace: alert.alert_report(
        driver.prices(spark, sf, params), lookups.fundamentals_table(driver.fundamentals_raw(spark, sf)),
        sectors if sectors is not None else driver.sectors(spark, sf), driver.news_source(spark, sf),
        facts_for, params, trace), attempts)


@register("status_no_shared_sector")
def q_status_no_shared_sector(spark, sf):
    """Every stock alone in its sector."""
    alone = driver.sectors(spark, sf).select("symbol", F.col("symbol").cast("string").alias("core_focus"))
    out = _scratch(spark, "job")
    _job(spark, sf, out, sectors=alone)
    return sinks.read_status(spark, f"{out}/status")


@register("status_no_future_sector")
def q_status_no_future_sector(spark, sf):
    """Shared sectors, none of them with future potential."""
    out = _scratch(spark, "job")
    _job(spark, sf, out, facts_for=lambda shared: driver.sector_facts(shared).withColumn(
        "is_core_focus_future_potential", F.lit(False)))
    return sinks.read_status(spark, f"{out}/status")


@register("status_after_failure")
def q_status_after_failure(spark, sf):
    """A good run of one day, a run of the next day that fails, and a failing
    re-run of the first day: two status rows, and no report left standing."""
    out = _scratch(spark, "job")
    next_day = P.with_(end_date=P.end_date + _dt.timedelta(days=1))
    _job(spark, sf, out)

    def fails(shared):
        raise ValueError("the describer is not available")

    for params in (next_day, P):
        try:
            _job(spark, sf, out, params=params, facts_for=fails)
        except ValueError:
            pass
    left = sinks.read_report(spark, f"{out}/report", document=True).count()
    return sinks.read_status(spark, f"{out}/status").withColumn("report_rows", F.lit(left).cast("bigint"))


@register("status_after_attempts")
def q_status_after_attempts(spark, sf):
    """A run whose describer fails twice, first by an error and then by
    finding no sector with potential, and answers at the third attempt."""
    out, calls = _scratch(spark, "job"), []

    def describe(shared):
        calls.append(1)
        if len(calls) == 1:
            raise ValueError("the describer is not available")
        facts = driver.sector_facts(shared)
        return facts if len(calls) > 2 else facts.withColumn("is_core_focus_future_potential", F.lit(False))

    _job(spark, sf, out, facts_for=describe, attempts=job.JOB_ATTEMPTS)
    left = sinks.read_report(spark, f"{out}/report", document=True).where("part = 1").count()
    return sinks.read_status(spark, f"{out}/status").withColumn("stocks", F.lit(left).cast("bigint"))


@register("model_rejects")
def q_model_rejects(spark, sf):
    """One call per passage; by a fixed rule of its id the model refuses, cuts
    its array off, sends two arrays or a key of another type."""
    items = driver.table(spark, sf, "benchmark").select(F.col("item_id").alias("symbol"), "text")

    def moody(records):
        good = inference.keyword_sector_predict(records)
        return {1: "I cannot help with that.", 2: good[:len(good) // 2], 3: good + good,
                4: good.replace('"symbol": ', '"symbol": "no. ", "id": ')}.get(records[0]["symbol"] % 6, good)

    rows, rejects = inference.classify(items, moody, max_records=1)
    kept = items.select("symbol").join(rows, "symbol", "left")
    n = rejects.agg(F.coalesce(F.sum("n_lost"), F.lit(0)).cast("bigint").alias("n")).first()["n"]
    return kept.select("symbol", F.coalesce("core_focus", F.lit("rejected")).alias("core_focus"),
                       F.lit(n).cast("bigint").alias("records_lost"))


# ---------------------------------------------------------------- streaming

def _tick_folder(spark, sf, name):
    """The ticks as a folder of files: (folder, function that adds the ticks
    that arrive late, every seventh by id)."""
    folder = f"{_scratch(spark, name)}/ticks"
    ev = driver.table(spark, sf, "events")
    late = F.pmod("event_id", F.lit(7)) == 0
    ev.where(~late).write.mode("append").parquet(folder)
    return folder, lambda: ev.where(late).write.mode("append").parquet(folder)


@register("stream_daily_bars")
def q_stream_daily_bars(spark, sf):
    """Two runs, the second with ticks that arrive late (a watermark as long
    as the window keeps their days open)."""
    folder, add_late = _tick_folder(spark, sf, "stream_daily_bars")
    base = folder.removesuffix("/ticks")
    run = lambda: daily.stream_daily_bars(
        spark, folder, f"{base}/store", P, f"{base}/chk", watermark=f"{P.window_days + 1} days", max_files_per_trigger=1000)
    run()
    add_late()
    return run()


@register("stream_daily_screen")
def q_stream_daily_screen(spark, sf):
    """Two runs: late ticks are merged into the store and their symbols are
    screened again, the others' rows kept."""
    folder, add_late = _tick_folder(spark, sf, "stream_daily_screen")
    base = folder.removesuffix("/ticks")
    run = lambda: daily.incremental_screen(
        spark, folder, f"{base}/store", P, f"{base}/chk", max_files_per_trigger=1000)
    run()
    add_late()
    return run()


@register("stateful_screen")
def q_stateful_screen(spark, sf):
    """Two runs, the second with late ticks, the bars in the stream's state."""
    folder, add_late = _tick_folder(spark, sf, "stateful_screen")
    base = folder.removesuffix("/ticks")
    run = lambda: stateful.stateful_screen(
        spark, folder, f"{base}/screens", P, f"{base}/chk", watermark=f"{P.window_days + 1} days", max_files_per_trigger=1000)
    run()
    add_late()
    return run()


# ---------------------------------------------------------------- model-driven flow

@register("alert_report_inferred")
def q_alert_report_inferred(spark, sf):
    """Sectors from the (default, keyword) classifier over each survivor's
    company text -- the document with the symbol's id -- instead of the
    bound segment column.  The text is looked up for the survivors only."""
    docs = driver.table(spark, sf, "documents").select(
        F.col("doc_id").alias("symbol"), F.col("text").alias("description"))
    return alert.alert_report_inferred(
        driver.prices(spark, sf, P), lookups.fundamentals_table(driver.fundamentals_raw(spark, sf)),
        driver.news_source(spark, sf), P, descriptions=docs)


@register("daily_job_status")
def q_daily_job_status(spark, sf):
    return job.run_daily(spark, sf, _scratch(spark, "daily_job"), P)


# ---------------------------------------------------------------- raw provider inputs

@register("bars_from_replies")
def q_bars_from_replies(spark, sf):
    """Bars from JSON replies, one per symbol, made of the bound bars; every
    fifth symbol's reply is an error page and gives no rows."""
    bar = F.struct(F.col("date").cast("string").alias("date"), "close")
    raw = (driver.prices(spark, sf, P).groupBy("symbol")
           .agg(F.to_json(F.array_sort(F.collect_list(bar))).alias("body"))
           .withColumn("body", F.when(F.pmod("symbol", F.lit(5)) == 0, F.lit("<html>too many requests</html>"))
                       .otherwise(F.col("body"))))
    return bars.price_window_scan(bars.bars_from_json(raw), P.start_date + _dt.timedelta(days=2), P.end_date)


@register("bars_from_archive")
def q_bars_from_archive(spark, sf):
    """Bars of the listed symbols from an archive of reply files, made of the
    bound history by symbol and month; every fifth symbol's are error pages,
    which become rejects, and every seventh's hold a bar without a date."""
    path = f"{_scratch(spark, 'replies')}/archive"
    bar = F.struct(F.col("date").cast("string").alias("date"), "close")
    undated = F.when(F.pmod("symbol", F.lit(7)) == 0, F.array(F.struct(F.lit("no date").alias("date"), F.lit(1.0).alias("close"))))
    raw = (_history(spark, sf).groupBy("symbol", F.date_format("date", "yyyy-MM").alias("month"))
           .agg(F.array_sort(F.collect_list(bar)).alias("b"))
           .withColumn("b", F.concat("b", F.coalesce(undated, F.array_except("b", "b"))))
           .select("symbol", "month", F.when(F.pmod("symbol", F.lit(5)) == 0, F.lit("<html>too many requests</html>"))
                   .otherwise(F.to_json("b")).alias("body")))
    replies.archive(raw, path)
    good, rejects = replies.bars_and_rejects(spark, path, P.start_date + _dt.timedelta(days=2), P.end_date,
                                             driver.exchange_listing(spark, sf, "NYSE"))
    none = F.lit(None)
    return good.withColumn("reason", none.cast("string")).unionByName(
        rejects.select("symbol", none.cast("date").alias("date"), none.cast("double").alias("close"), "reason"))


@register("screen_from_store")
def q_screen_from_store(spark, sf):
    """The screen on a bar store bucketed by symbol, filled by two merges."""
    name = f"bars_{uuid.uuid4().hex}"
    store.create(spark, name, f"{_scratch(spark, 'bar_store')}/bars", buckets=8)
    ticks = bars.with_tick_order(driver.ticks(spark, sf).where("user_id is not null"))
    late = F.pmod("event_id", F.lit(7)) == 0
    for part in (ticks.where(~late), ticks.where(late)):
        store.merge(bars.partial_daily_bars(part), name)
    return momentum.momentum_screen(store.bars(spark, name, P.start_date, P.end_date), P)


@register("news_from_replies")
def q_news_from_replies(spark, sf):
    """Articles from JSON replies, one per symbol, made of the bound news."""
    article = F.struct("article_id", "title", "article_url", F.col("published").cast("string").alias("published_utc"))
    raw = (driver.news(spark, sf).groupBy("symbol")
           .agg(F.array_sort(F.collect_list(article)).alias("results"))
           .select("symbol", F.to_json(F.struct("results")).alias("body")))
    return lookups.news_top(lookups.news_from_json(raw), P)


@register("listing_scan")
def q_listing_scan(spark, sf):
    """One listing table with an exchange column."""
    listing = (driver.exchange_listing(spark, sf, "NYSE").withColumn("exchange", F.lit("NYSE"))
               .unionByName(driver.exchange_listing(spark, sf, "NASDAQ").withColumn("exchange", F.lit("NASDAQ")))
               .withColumnRenamed("symbol", "Code"))
    return listings.universe(listings.listing_symbols(listing, "NYSE"), listings.listing_symbols(listing, "NASDAQ"))


@register("good_and_bad_records")
def q_good_and_bad_records(spark, sf):
    """Both frames of the split: parsed records and rejects."""
    raw = driver.table(spark, sf, "events").select(
        "event_id", F.when(F.pmod("event_id", F.lit(9)) == 0, F.concat(F.lit("!"), "props")).otherwise(F.col("props")).alias("body"))
    good, bad = records.split_bad_records(raw, "body", T.StructType([T.StructField("k", T.LongType())]))
    return good.select("event_id", "k", F.lit(None).cast("string").alias("raw_record")).unionByName(
        bad.select("event_id", F.lit(None).cast("bigint").alias("k"), "raw_record"))


@register("canonical_sectors")
def q_canonical_sectors(spark, sf):
    """Labels spelled three ways, brought to one."""
    c = driver.sectors(spark, sf)
    spelled = (F.when(F.pmod("symbol", F.lit(5)) == 0, F.lower("core_focus"))
               .when(F.pmod("symbol", F.lit(5)) == 1, F.concat(F.lit("  "), F.initcap("core_focus"))).otherwise(F.col("core_focus")))
    return labels.canonicalize(c.select("symbol", spelled.alias("core_focus")))


@register("localize_by_table")
def q_localize_by_table(spark, sf):
    dictionary = spark.createDataFrame(sorted(localize.HEBREW.items()), "source_text string, target_text string")
    return localize.localize_with_table(driver.sectors(spark, sf), {"core_focus": "core_focus_local"}, dictionary)


@register("report_from_lookups")
def q_report_from_lookups(spark, sf):
    """The enrichment on its own, from looked-up inputs."""
    screened = momentum.momentum_screen(driver.prices(spark, sf, P), P)
    fund = lookups.fundamentals_table(driver.fundamentals_raw(spark, sf))
    overview = materialize(lookups.fundamentals_lookup(fund, momentum.screened_symbols(screened), P))
    sec = driver.sectors(spark, sf).join(overview.select("symbol"), "symbol", "left_semi")
    facts = driver.sector_facts(driver.sectors(spark, sf).select("core_focus").distinct())
    return alert.report_from_lookups(screened, overview, lookups.news_top(driver.news(spark, sf), P), sec, facts)
