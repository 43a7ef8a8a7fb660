"""The flagship composite: screen -> lookups -> sectors -> one row per stock.

Plan shape: the bar screen is the only large input.  It runs once -- one
Exchange on ``symbol`` for all bar windows, plus the partial-aggregated
tick roll-up before it -- and its per-symbol result is joined with the
fundamentals and cap-filtered into the *survivor* table, which has at most
one row per symbol.  That table is materialised (reliable checkpoint in
``spark.checkpoint.dir``) because four branches use it: sector lookup,
shared-sector counts, news lookup and the final join.  Without it every
branch would re-scan and re-window the bars.  Every other input is
semi-joined with the survivors first, so AQE broadcasts the survivor side
when its measured size is under the threshold; sector counts shuffle by
(sector, symbol) and then by sector with partial counts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risingtide.operators import enrich, inference, labels, momentum
from risingtide.operators import sectors as sector_ops
from risingtide.params import ScreenParams
from risingtide.session import broadcast_hint, materialize, materialize_measured
from risingtide.sources import lookups


def survivors(prices: DataFrame, fundamentals: DataFrame, params: ScreenParams) -> DataFrame:
    """Screened symbols whose market cap passes, one row per symbol:
    ``(symbol, company_overview, marketCap, last_price, last_percent,
    start_end_percent)``, lazy.

    ``fundamentals`` is keyed by symbol and the per-symbol screen is
    distinct, so the inner join equals the reference's lookup-then-merge.
    """
    per_symbol = momentum.screened_symbols(momentum.momentum_screen(prices, params))
    return lookups.cap_filter(fundamentals.join(per_symbol, "symbol"), params).dropDuplicates()


def survivor_keys(prices: DataFrame, fundamentals: DataFrame, params: ScreenParams
                  ) -> tuple[DataFrame, DataFrame]:
    """``(survivors, keys)``: the materialised survivor table and its
    ``symbol`` column, with a broadcast hint when the keys are within the
    row and byte bounds.  The keys are measured while the survivors are
    written, so the size check adds no job."""
    surv, n, size = materialize_measured(survivors(prices, fundamentals, params), cols=["symbol"])
    return surv, broadcast_hint(surv.select("symbol"), n, size)


@dataclass
class Trace:
    """Materialised frames a report run went through, for its status: which
    guard left nothing, and what the model's replies lost."""

    survivors: DataFrame | None = None
    shared: DataFrame | None = None
    facts: DataFrame | None = None
    rejects: list[tuple[str, DataFrame]] = field(default_factory=list)

    def empty_reason(self) -> str:
        """Why a report has no rows: the first step that left nothing."""
        for frame, reason in ((self.survivors, "no stock passed the screen"),
                              (self.shared, "no sector is shared by two stocks")):
            if frame is not None and not frame.take(1):
                return reason
        if self.facts is not None and not sector_ops.future_sectors(self.facts).take(1):
            return "no shared sector has future potential"
        return "no stock is left in a relevant sector"


def report_from_lookups(screened: DataFrame, overview: DataFrame, news_top: DataFrame,
                        sectors: DataFrame, facts: DataFrame) -> DataFrame:
    """The enrichment stage on its own, from already looked-up inputs (the
    reference's in-memory entry): ``screened`` may hold one row per up-day,
    ``overview`` the cap-passed fundamentals, ``news_top`` ranked articles
    ``(symbol, news_rank, news_data, news_source)``, ``sectors`` the
    classifier output and ``facts`` the sector description.  Sectors with a
    single member are dropped here too (facts exist only for shared ones)."""
    per_symbol = momentum.screened_symbols(screened)
    shared = sector_ops.shared_sectors(sectors)
    facts_shared = facts.join(shared, "core_focus", "left_semi")
    if "article_id" not in news_top.columns:
        news_top = news_top.withColumn("article_id", F.lit(None).cast("bigint"))
    rows = enrich.enriched_rows(sectors, facts_shared, overview, per_symbol)
    return enrich.alert_rows(rows, news_top)


def alert_report(prices: DataFrame, fundamentals: DataFrame,
                 sectors: DataFrame | Callable[[DataFrame], DataFrame],
                 news: DataFrame | Callable[[DataFrame], DataFrame],
                 facts_for: Callable[[DataFrame], DataFrame],
                 params: ScreenParams, trace: Trace | None = None) -> DataFrame:
    """One row per screened stock in a shared, future-potential sector.

    ``fundamentals`` is ``(symbol, company_overview, marketCap)``;
    ``sectors`` is ``(symbol, core_focus)`` (e.g. the output of the
    classifier), or a function of the survivor keys returning those rows --
    then a classifier runs for the survivors only, as the reference's did;
    ``facts_for`` maps the shared sectors to their facts (the
    sector describer); ``news`` is ``(symbol, article_id, published, title,
    article_url)``.
    """
    # size-checked static broadcast: the large sector and news tables are
    # filtered map-side without being shuffled
    surv, kept = survivor_keys(prices, fundamentals, params)
    # the survivors' sector rows feed both the shared-sector count and the
    # final join: materialised (survivor-sized), the sector table is read once
    source = sectors(kept) if callable(sectors) else sectors
    sec = materialize(source.join(kept, "symbol", "left_semi").select("symbol", "core_focus").distinct())
    return _report(surv, kept, sec, facts_for, news, params, trace)


def _report(surv, kept, sec, facts_for, news, params, trace) -> DataFrame:
    shared = sector_ops.shared_sectors(sec)
    facts = facts_for(shared)
    if trace is not None:
        trace.survivors, trace.shared, trace.facts = surv, shared, facts
    news_top = lookups.news_top(news, params, symbols=kept)
    return enrich.alert_rows(enrich.enriched_rows(sec, facts, surv), news_top)


class ModelReplyError(RuntimeError):
    """No reply of a model step could be used although records were sent."""


def alert_report_inferred(prices: DataFrame, fundamentals: DataFrame,
                          news: DataFrame | Callable[[DataFrame], DataFrame],
                          params: ScreenParams, classify_predict=None, describe_predict=None,
                          descriptions: DataFrame | None = None, trace: Trace | None = None,
                          max_records: int = inference.MAX_RECORDS_PER_CALL) -> DataFrame:
    """The reference's own flow: the sector of each survivor comes from the
    classifier (U1) over its company overview, labels are canonicalised
    (T2), shared sectors are described by a second model call (U1), then
    the same joins as ``alert_report``.

    Every model step calls once and keeps its replies.  Replies that give
    less than they were asked go to ``trace.rejects``; a step none of whose
    replies can be used raises ``ModelReplyError``, so a run can't pass for
    one without relevant stocks.

    ``descriptions`` ``(symbol, description)``, when given, supplies the
    company text instead of ``fundamentals.company_overview`` (missing text
    reads ``""``).  It is looked up for the survivors only -- a semi-join
    with the size-checked survivor keys -- so a large text table is filtered
    where it is read instead of being joined whole to the fundamentals.
    """
    trace = trace if trace is not None else Trace()
    surv, kept = survivor_keys(prices, fundamentals, params)
    trace.survivors = surv
    if descriptions is not None:
        text = descriptions.join(kept, "symbol", "left_semi").select(
            "symbol", F.col("description").alias("_text"))
        surv = materialize(
            surv.join(text, "symbol", "left")
            .withColumn("company_overview", F.coalesce(F.col("_text"), F.lit("")))
            .select(*surv.columns).dropDuplicates())

    def checked(step: str, out: tuple[DataFrame, DataFrame]) -> DataFrame:
        rows, rejects = out
        trace.rejects.append((step, rejects))
        if not rows.take(1) and rejects.take(1):
            raise ModelReplyError(f"{step}: no reply of the model could be used")
        return rows

    raw_sec = checked("classify", inference.classify(surv, classify_predict, key="symbol", text="company_overview",
                                                     max_records=max_records))
    sec = materialize(labels.canonicalize(raw_sec))
    return _report(surv, kept, sec, lambda shared: checked("describe", inference.describe_sectors(
        shared, describe_predict, max_records=max_records)), news, params, trace)
