import datetime as dt

from pyspark.sql import functions as F

from risingtide.operators import enrich, sectors
from risingtide.params import ScreenParams
from risingtide.sources import lookups

P = ScreenParams(end_date=dt.date(2024, 1, 10), window_days=10, min_market_cap=1000)


def test_cap_filter_strict_and_missing(spark):
    raw = spark.createDataFrame(
        [(1, "a", 1000.4), (2, "b", 1000.5), (3, "c", 1001.5), (4, None, None)],
        "symbol bigint, description string, market_cap double")
    f = lookups.fundamentals_table(raw)
    caps = {r.symbol: (r.company_overview, r.marketCap) for r in f.collect()}
    assert caps[1][1] == 1000 and caps[2][1] == 1000    # half-even: 1000.5 -> 1000
    assert caps[3][1] == 1002 and caps[4] == ("", 0)
    assert {r.symbol for r in lookups.cap_filter(f, P).collect()} == {3}


def test_json_defaults(spark):
    raw = spark.createDataFrame(
        [(1, '{"results": {"description": "x", "market_cap": 2.5}}'),
         (2, '{"results": {}}'), (3, '{}'), (4, None)], "symbol bigint, body string")
    got = {r.symbol: (r.company_overview, r.marketCap)
           for r in lookups.fundamentals_from_json(raw).collect()}
    assert got == {1: ("x", 2), 2: ("", 0), 3: ("", 0), 4: ("", 0)}


def news_frame(spark, rows):
    return spark.createDataFrame(
        rows, "symbol bigint, article_id bigint, published date, title string, article_url string")


def test_news_top3_window_ties_and_missing_fields(spark):
    d = dt.date
    rows = [(1, i, d(2024, 1, 8), f"t{i}", f"u{i}") for i in range(5)]       # 5 tied dates
    rows += [(1, 9, d(2023, 12, 1), "old", "u9")]                              # outside window
    rows += [(2, 20, d(2024, 1, 5), None, "u20"), (2, 21, d(2024, 1, 4), "t21", None)]
    top = lookups.news_top(news_frame(spark, rows), P)
    got = sorted((r.symbol, r.news_rank, r.article_id) for r in top.collect())
    assert got == [(1, 1, 0), (1, 2, 1), (1, 3, 2), (2, 1, 20), (2, 2, 21)]
    agg = {r.symbol: (r.news_data, r.news_source) for r in enrich.news_per_symbol(top).collect()}
    assert agg[1] == ("t0***t1***t2", "u0***u1***u2")
    assert agg[2] == ("no data***t21", "u20***no data")


def test_news_plan_limits_before_shuffle(spark):
    rows = [(1, i, dt.date(2024, 1, 8), "t", "u") for i in range(5)]
    plan = lookups.news_top(news_frame(spark, rows), P)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_shared_sectors_and_flag(spark):
    sec = spark.createDataFrame(
        [(1, "ai"), (2, "ai"), (2, "ai"), (3, "solo"), (4, "nuc"), (5, "nuc")],
        "symbol bigint, core_focus string")
    assert {r.core_focus for r in sectors.shared_sectors(sec).collect()} == {"ai", "nuc"}
    counts = {(r.symbol, r.core_focus): r.core_focus_count
              for r in sectors.sector_nunique(sec).collect()}
    assert counts[(2, "ai")] == 2 and counts[(3, "solo")] == 1
    facts = spark.createDataFrame(
        [("ai", "o", True, "p"), ("nuc", "o", False, "p")],
        "core_focus string, core_focus_overview string, is_core_focus_future_potential boolean, "
        "core_focus_future_potential_overview string")
    assert [r.core_focus for r in sectors.future_sectors(facts).collect()] == ["ai"]
    joined = sectors.sector_join(sec.distinct(), facts)
    assert sorted(r.symbol for r in joined.collect()) == [1, 2]


def test_flag_as_string_does_not_pass(spark):
    from risingtide.operators.inference import FACTS_ELEMENT, parse_replies
    replies = spark.createDataFrame(
        [("1", 1, 'x [{"core_focus": "ai", "is_core_focus_future_potential": "true"},'
                  ' {"core_focus": "ev", "is_core_focus_future_potential": true}] y')],
        "batch_key string, n_records int, reply string")
    rows, rejects = parse_replies(replies, FACTS_ELEMENT)
    got = {r.core_focus: r.is_core_focus_future_potential for r in rows.collect()}
    # a string where a boolean is expected parses to NULL: the sector stays
    # but does not pass the flag predicate
    assert got == {"ai": None, "ev": True}
    assert rejects.count() == 0


def test_alert_rows_no_news_fills(spark):
    rows = spark.createDataFrame(
        [(1, "ai", "o", True, "p", "co", 5000, 10.0, 6.0, 25.0)],
        "symbol bigint, core_focus string, core_focus_overview string, "
        "is_core_focus_future_potential boolean, core_focus_future_potential_overview string, "
        "company_overview string, marketCap bigint, last_price double, last_percent double, "
        "start_end_percent double")
    empty = news_frame(spark, []).withColumn("news_rank", F.lit(1)).select(
        "symbol", "article_id", "published", "news_rank", F.col("title").alias("news_data"),
        F.col("article_url").alias("news_source"))
    out = enrich.alert_rows(rows, empty).collect()
    assert len(out) == 1 and out[0].news_data == "no data" and out[0].news_source == "no data"
    assert out[0].marketCap == 5000


def test_split_bad_records(spark):
    from pyspark.sql import types as T

    from risingtide.sources import records

    raw = spark.createDataFrame(
        [(1, '{"k": 5}'), (2, "not json"), (3, '{"k": "x"}'), (4, None), (5, "[1, 2]")],
        "record_id bigint, body string")
    schema = T.StructType([T.StructField("k", T.LongType())])
    good, rejects = records.split_bad_records(raw, "body", schema)
    assert sorted((r.record_id, r.k) for r in good.collect()) == [(1, 5)]
    assert sorted(r.record_id for r in rejects.collect()) == [2, 3, 4, 5]
    tags = {r.record_id: r.status for r in records.tag_bad_records(raw, "body", schema).collect()}
    assert tags == {1: "ok", 2: "rejected", 3: "rejected", 4: "rejected", 5: "rejected"}


def test_json_default_for_a_value_of_another_type(spark):
    raw = spark.createDataFrame(
        [("A", '{"results": {"description": "x", "market_cap": "n/a"}}'),
         ("B", '{"results": {"market_cap": 1234.5}}')], "symbol string, body string")
    got = {r.symbol: (r.company_overview, r.marketCap)
           for r in lookups.fundamentals_from_json(raw).collect()}
    assert got == {"A": ("x", 0), "B": ("", 1234)}


def test_listing_symbols_and_universe(spark):
    from risingtide.sources import listings

    lst = spark.createDataFrame([("NYSE", "A"), ("NYSE", "B"), ("NASDAQ", "B"), ("NASDAQ", "C"),
                                 ("OTC", "D")], "exchange string, Code string")
    nyse = listings.listing_symbols(lst, "NYSE")
    nasdaq = listings.listing_symbols(lst, "NASDAQ")
    assert sorted(r.symbol for r in listings.universe(nyse, nasdaq).collect()) == ["A", "B", "B", "C"]
    plan = nyse._jdf.queryExecution().executedPlan().toString()
    assert "exchange" in plan and "NYSE" in plan


def test_news_from_json_is_tolerant(spark):
    p = ScreenParams(end_date=dt.date(2024, 1, 30), window_days=10)
    raw = spark.createDataFrame([
        ("OKLO", '{"results": [{"title": "a", "article_url": "u1", "published_utc": "2024-01-29T10:00:00Z"},'
                 ' {"title": "b", "published_utc": "2024-01-29T09:00:00Z"},'
                 ' {"article_url": "u3", "published_utc": "2024-01-29T08:00:00Z"},'
                 ' {"title": "d", "article_url": "u4", "published_utc": "2024-01-28T08:00:00Z"}]}'),
        ("SMR", '{"status": "OK"}'), ("NNE", "not json")], "symbol string, body string")
    news = lookups.news_from_json(raw)
    assert news.count() == 4
    top = lookups.news_top(news, p)
    got = [(r.news_rank, r.news_data, r.news_source) for r in top.orderBy("news_rank").collect()]
    # same day: the provider's order decides; the fourth article drops out
    assert got == [(1, "a", "u1"), (2, "b", None), (3, None, "u3")]
    assert enrich.news_per_symbol(top).first().news_data == "a***b***no data"
