"""Sector grouping (A2, A4, F5, F6, JN2, P6).

``sectors`` is ``(symbol, core_focus)``; ``facts`` is one row per sector with
``core_focus_overview``, ``is_core_focus_future_potential`` (boolean) and
``core_focus_future_potential_overview``.

A sector can hold a large share of all symbols, so distinct counts are
computed in two steps: ``distinct (core_focus, symbol)`` spreads a hot
sector over all shuffle partitions by both keys, then a per-sector count
runs with map-side partial aggregation, so the final shuffle carries one
row per (sector, map task).  No symbol list is ever collected per sector.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risingtide.session import checked_broadcast

FACT_COLUMNS = ["core_focus_overview", "is_core_focus_future_potential",
                "core_focus_future_potential_overview"]


def sector_member_counts(sectors: DataFrame) -> DataFrame:
    """``(core_focus, core_focus_count)``: distinct symbols per sector."""
    return (sectors.where(F.col("symbol").isNotNull() & F.col("core_focus").isNotNull())
            .select("core_focus", "symbol").distinct()
            .groupBy("core_focus").agg(F.count(F.lit(1)).alias("core_focus_count")))


def sector_nunique(sectors: DataFrame) -> DataFrame:
    """Every row with the distinct-symbol count of its sector.

    The counts have one row per sector.  They are materialised and, after a
    row-count check, broadcast, so the rows of a hot sector are never
    shuffled to one task; above the bound a shuffle join (with AQE skew
    splitting) remains.
    """
    return sectors.join(checked_broadcast(sector_member_counts(sectors)), "core_focus")


def shared_sectors(sectors: DataFrame, min_members: int = 2) -> DataFrame:
    """F6 + A4 + P6: the sectors with at least ``min_members`` distinct
    symbols, one row ``(core_focus)`` each."""
    return (sector_member_counts(sectors)
            .where(F.col("core_focus_count") >= min_members)
            .select("core_focus"))


def future_sectors(facts: DataFrame) -> DataFrame:
    """sectors whose flag is boolean true.  The flag column is typed, so
    a string ``"true"`` from a sloppy reply was already parsed to NULL and
    does not pass."""
    return facts.where(F.col("is_core_focus_future_potential") == F.lit(True))


def sector_join(sectors: DataFrame, facts: DataFrame) -> DataFrame:
    """JN2: symbol rows joined with the facts of their (future) sector.
    Facts exist only for shared sectors, so the inner join also drops
    single-member sectors."""
    return sectors.join(future_sectors(facts), "core_focus")
