"""Report building (A7, A8, F7, ST1-ST4, AR1-AR3, M3, D2, O2).

The reference rendered one HTML string on the driver, scanning the rows
four times per sector.  Here a report is a DataFrame of fragments, one row
per sector header and one per stock, each rendered with built-in string
functions in the executors.  The document is the fragments in
``(core_focus, part, symbol)`` order, which a sink writes with a
distributed sort -- no document is ever assembled in one task or on the
driver.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risingtide.functions.text import split_joined, zip_shortest
from risingtide.params import MISSING_TEXT

SECTION_PART = 0
STOCK_PART = 1
# Blocks of the document, in order: title, list of sectors, body.
TITLE_BLOCK = 0
CONTENTS_BLOCK = 1
BODY_BLOCK = 2
REPORT_TITLE = "Momentum digest"


def report_sections(rows: DataFrame, report_date: _dt.date) -> DataFrame:
    """A7 + A8 + D2: one row per sector with its facts.  The reference took
    the facts of the sector's first row; ``min_by(..., symbol)`` makes
    "first" deterministic and is a partial aggregate, so a large sector is
    combined map-side."""
    return (rows.groupBy("core_focus")
            .agg(F.min_by("core_focus_overview", "symbol").alias("core_focus_overview"),
                 F.min_by("is_core_focus_future_potential", "symbol")
                 .alias("is_core_focus_future_potential"),
                 F.min_by("core_focus_future_potential_overview", "symbol")
                 .alias("core_focus_future_potential_overview"),
                 F.count(F.lit(1)).alias("n_stocks"))
            .withColumn("report_date", F.date_format(F.lit(report_date), "yyyy-MM-dd")))


def escaped(c: Column) -> Column:
    """Text as HTML content or attribute value; titles and links come from
    web pages."""
    for ch, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(ch), F.lit(entity))
    return c


def _news_item(p):
    return F.concat(F.lit('<li><a href="'), escaped(p["s"]), F.lit('">'), escaped(p["d"]), F.lit("</a></li>"))


def report_items(rows: DataFrame) -> DataFrame:
    """ST1-ST3 + AR1-AR3 + M3: per stock, the display values and its news
    list.  News strings are split on the literal separator, trimmed, zipped
    to the shorter side and de-duplicated as (title, url) pairs, keeping the
    first occurrence -- titles and links stay aligned (H9)."""
    pairs = F.array_distinct(zip_shortest(split_joined(F.col("news_data")),
                                          split_joined(F.col("news_source")), "d", "s"))
    return rows.select(
        "symbol", "core_focus", "company_overview",
        F.format_number(F.col("marketCap"), 0).alias("market_cap_text"),
        F.col("last_price"),
        F.round(F.col("last_percent"), 2).alias("last_percent_2"),
        F.round(F.col("start_end_percent"), 2).alias("start_end_percent_2"),
        F.size(pairs).alias("n_news"),
        F.array_join(F.transform(pairs, _news_item), "").alias("news_html"))


def _num(c, decimals: int = 2):
    return F.coalesce(F.format_number(c, decimals), F.lit(MISSING_TEXT))


def report_fragments(rows: DataFrame, report_date: _dt.date) -> DataFrame:
    """ST4 + F7 + O2: ``(core_focus, part, symbol, html)`` fragments.  Part 0
    is the sector header, part 1 one stock."""
    symbol_type = rows.schema["symbol"].dataType  # ticker text or numeric id
    sections = report_sections(rows, report_date).select(
        "core_focus", F.lit(SECTION_PART).alias("part"),
        F.lit(None).cast(symbol_type).alias("symbol"),
        F.concat(F.lit("<section><h2>"), escaped(F.col("core_focus")), F.lit("</h2><dl>"),
                 _term("Stocks", F.col("n_stocks").cast("string")),
                 _term("Why it may grow", escaped(F.col("core_focus_future_potential_overview"))),
                 _term("What it is", escaped(F.col("core_focus_overview"))),
                 F.lit("</dl></section>")).alias("html"))
    items = report_items(rows).select(
        "core_focus", F.lit(STOCK_PART).alias("part"), "symbol",
        F.concat(F.lit("<article><table><caption>"), escaped(F.col("symbol").cast("string")), F.lit("</caption>"),
                 _cell("Gain in window, %", _num(F.col("start_end_percent_2"))),
                 _cell("Last day, %", _num(F.col("last_percent_2"))),
                 _cell("Last close, USD", _num(F.col("last_price"))),
                 _cell("Market value, USD", F.col("market_cap_text")),
                 F.lit("</table><ol>"), F.col("news_html"), F.lit("</ol><blockquote>"),
                 escaped(F.col("company_overview")), F.lit("</blockquote></article>")).alias("html"))
    return sections.unionByName(items)


def _term(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"<dt>{name}</dt><dd>"), value, F.lit("</dd>"))


def _cell(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"<tr><th>{name}</th><td>"), value, F.lit("</td></tr>"))


def report_document(rows: DataFrame, report_date: _dt.date) -> DataFrame:
    """ST4 + A7 + D2: the whole report as ``(block, core_focus, part,
    symbol, html)`` fragments -- a title with the run date (one row, only
    when there is something to report), one list item per sector, then the
    body of ``report_fragments``.  Read in ``(block, core_focus, part,
    symbol)`` order the fragments are the document; every fragment is
    rendered from one sector or one stock, so no row holds the whole
    document."""
    symbol_type = rows.schema["symbol"].dataType
    sections = report_sections(rows, report_date)
    no_symbol = F.lit(None).cast(symbol_type).alias("symbol")
    title = (sections.groupBy("report_date").agg(F.count(F.lit(1)).alias("_n"))
             .select(F.lit(TITLE_BLOCK).alias("block"), F.lit(None).cast("string").alias("core_focus"),
                     F.lit(SECTION_PART).alias("part"), no_symbol,
                     F.concat(F.lit(f"<h1>{REPORT_TITLE}, "), F.col("report_date"),
                              F.lit("</h1>")).alias("html")))
    contents = sections.select(
        F.lit(CONTENTS_BLOCK).alias("block"), "core_focus", F.lit(SECTION_PART).alias("part"),
        no_symbol, F.concat(F.lit("<li>"), escaped(F.col("core_focus")), F.lit("</li>")).alias("html"))
    body = report_fragments(rows, report_date).select(F.lit(BODY_BLOCK).alias("block"), "*")
    return title.unionByName(contents).unionByName(body)


def html_document(document: DataFrame) -> DataFrame:
    """``report_document`` with the markup around its blocks as rows of their
    own: read in order it is a whole HTML document.  A report without rows
    stays without any."""
    title = document.where(F.col("block") == TITLE_BLOCK)
    frame = F.array(*[F.struct(F.lit(block).alias("block"), F.lit(html).alias("html")) for block, html in (
        (TITLE_BLOCK - 1, '<!DOCTYPE html><html><head><meta charset="utf-8"></head><body>'),
        (CONTENTS_BLOCK, "<ul>"), (BODY_BLOCK, "</ul><main>"), (BODY_BLOCK + 1, "</main></body></html>"))])
    markup = (title.select(F.explode(frame).alias("f"), "part", "symbol")
              .select("f.block", F.lit(None).cast("string").alias("core_focus"), "part", "symbol", "f.html"))
    return document.unionByName(markup)
