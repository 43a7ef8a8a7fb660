"""The enrichment stage on small literal inputs shaped like the reference's
fixtures (rows invented): repeated screened rows per up-day, a symbol
without news, a single-member sector, a sector flagged false, a title and
a link missing."""

from risingtide.plans import alert

SCREENED = [("AAA", 12.0, 6.5, 25.0)] * 3 + [("BBB", 30.0, 7.0, 40.0)] * 4 + \
    [("CCC", 5.0, 8.0, 21.0)] * 3 + [("DDD", 9.0, 5.5, 22.0)] * 3 + [("EEE", 2.0, 9.0, 50.0)] * 3
OVERVIEW = [("AAA", "makes reactors", 150_000_000), ("BBB", "builds reactors", 300_000_000),
            ("CCC", "solar panels", 120_000_000), ("DDD", "batteries", 110_000_000),
            ("EEE", "other batteries", 101_000_000)]
NEWS = [("AAA", 1, "AAA wins a contract", "https://n/1"), ("AAA", 2, "AAA grows", None),
        ("BBB", 1, None, "https://n/3"), ("DDD", 1, "DDD news", "https://n/4")]
SECTORS = [("AAA", "Nuclear Energy"), ("BBB", "Nuclear Energy"), ("CCC", "Solar"),
           ("DDD", "Energy Storage"), ("EEE", "Energy Storage")]
FACTS = [("Nuclear Energy", "fission", True, "clean power"),
         ("Energy Storage", "batteries", False, "grid"),
         ("Solar", "sun", True, "cheap power")]


def test_report_from_lookups(spark):
    screened = spark.createDataFrame(
        SCREENED, "symbol string, last_price double, last_percent double, start_end_percent double")
    overview = spark.createDataFrame(OVERVIEW, "symbol string, company_overview string, marketCap bigint")
    news = spark.createDataFrame(NEWS, "symbol string, news_rank int, news_data string, news_source string")
    sectors = spark.createDataFrame(SECTORS, "symbol string, core_focus string")
    facts = spark.createDataFrame(
        FACTS, "core_focus string, core_focus_overview string, is_core_focus_future_potential boolean, "
               "core_focus_future_potential_overview string")
    out = {r.symbol: r for r in alert.report_from_lookups(screened, overview, news, sectors, facts).collect()}
    # Solar has one member; Energy Storage is not flagged
    assert set(out) == {"AAA", "BBB"}
    assert out["AAA"].news_data == "AAA wins a contract***AAA grows"
    assert out["AAA"].news_source == "https://n/1***no data"
    assert out["BBB"].news_data == "no data" and out["BBB"].news_source == "https://n/3"
    assert out["BBB"].marketCap == 300_000_000 and out["BBB"].last_price == 30.0
    assert len(out["AAA"]) == 12


def test_inferred_flow_calls_the_model_once_per_survivor(spark):
    from conftest import SF_SMALL
    from risingtide.operators import inference
    from risingtide.params import DRIVER_PARAMS as P
    from risingtide.sources import driver, lookups

    calls = spark.sparkContext.accumulator(0)

    def predict(records):
        calls.add(len(records))
        return inference.keyword_sector_predict(records)

    fund = lookups.fundamentals_table(driver.fundamentals_raw(spark, SF_SMALL))
    docs = driver.table(spark, SF_SMALL, "documents").selectExpr(
        "doc_id AS symbol", "text AS description")
    out = alert.alert_report_inferred(driver.prices(spark, SF_SMALL, P), fund,
                                      driver.news(spark, SF_SMALL), P,
                                      classify_predict=predict, descriptions=docs)
    out.collect()
    out.count()
    n = alert.survivors(driver.prices(spark, SF_SMALL, P), fund, P).count()
    assert n > 0 and calls.value == n


def test_report_fragments_keep_ticker_symbols(spark):
    import datetime as dt

    from risingtide.operators import report

    screened = spark.createDataFrame(
        SCREENED, "symbol string, last_price double, last_percent double, start_end_percent double")
    overview = spark.createDataFrame(OVERVIEW, "symbol string, company_overview string, marketCap bigint")
    news = spark.createDataFrame(NEWS, "symbol string, news_rank int, news_data string, news_source string")
    sectors = spark.createDataFrame(SECTORS, "symbol string, core_focus string")
    facts = spark.createDataFrame(
        FACTS, "core_focus string, core_focus_overview string, is_core_focus_future_potential boolean, "
               "core_focus_future_potential_overview string")
    rows = alert.report_from_lookups(screened, overview, news, sectors, facts)
    frags = report.report_fragments(rows, dt.date(2024, 1, 30)).orderBy("core_focus", "part", "symbol")
    got = [(r.core_focus, r.part, r.symbol) for r in frags.collect()]
    assert got == [("Nuclear Energy", 0, None), ("Nuclear Energy", 1, "AAA"), ("Nuclear Energy", 1, "BBB")]


def test_alert_report_on_ticker_tables(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from risingtide.params import ScreenParams
    from risingtide.sources import lookups

    p = ScreenParams(end_date=dt.date(2024, 1, 10), window_days=10, min_market_cap=100_000_000)
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    closes = {
        "OKLO": [10, 11, 12.1, 13.31, 13.31],        # 3 up-days (+10 %), gain 33 %
        "SMR": [5, 5.5, 6.05, 6.655, 7.3205],        # 4 up-days, gain 46 %
        "CLSK": [8, 8.8, 9.68, 9.68, 9.0],           # 2 up-days only
        "NNE": [20, 22, 24.2, 26.62, 26.0],          # 3 up-days, but cap too small
        "LONE": [1, 1.2, 1.44, 1.728, 1.8],          # passes, alone in its sector
    }
    bars = spark.createDataFrame([(s, day(i), float(c)) for s, cs in closes.items()
                                  for i, c in enumerate(cs)], "symbol string, date date, close double")
    fund = lookups.fundamentals_table(spark.createDataFrame(
        [("OKLO", "fission", 2.5e9), ("SMR", "modules", 1.0e9), ("CLSK", "mining", 3.0e9),
         ("NNE", "micro", 1.0e8), ("LONE", "other", 5.0e8)],
        "symbol string, description string, market_cap double"))
    sectors = spark.createDataFrame([("OKLO", "Nuclear"), ("SMR", "Nuclear"), ("CLSK", "Nuclear"),
                                     ("NNE", "Nuclear"), ("LONE", "Solar")],
                                    "symbol string, core_focus string")
    news = spark.createDataFrame(
        [("OKLO", 1, day(9), "OKLO wins", "u1"), ("OKLO", 2, day(8), "OKLO grows", None),
         ("SMR", 3, dt.date(2023, 12, 1), "too old", "u3")],
        "symbol string, article_id bigint, published date, title string, article_url string")

    def facts_for(shared):
        return shared.select("core_focus", F.lit("reactors").alias("core_focus_overview"),
                             F.lit(True).alias("is_core_focus_future_potential"),
                             F.lit("growing").alias("core_focus_future_potential_overview"))

    out = {r.symbol: r for r in alert.alert_report(bars, fund, sectors, news, facts_for, p).collect()}
    assert set(out) == {"OKLO", "SMR"}
    assert out["OKLO"].news_data == "OKLO wins***OKLO grows"
    assert out["OKLO"].news_source == "u1***no data"
    assert out["SMR"].news_data == "no data" and out["SMR"].marketCap == 1_000_000_000
    assert abs(out["SMR"].start_end_percent - 46.41) < 1e-9 and out["OKLO"].core_focus == "Nuclear"


def test_alert_report_evaluates_a_lazy_sector_input_once(spark):
    from conftest import SF_SMALL
    from risingtide.operators import inference
    from risingtide.params import DRIVER_PARAMS as P
    from risingtide.sources import driver, lookups

    calls = spark.sparkContext.accumulator(0)

    def predict(records):
        calls.add(len(records))
        return inference.keyword_sector_predict(records)

    # sectors straight from the classifier, not materialised by the caller
    docs = driver.table(spark, SF_SMALL, "documents").selectExpr("doc_id AS symbol", "text")
    sectors, _ = inference.classify(docs, predict=predict)
    out = alert.alert_report(driver.prices(spark, SF_SMALL, P),
                             lookups.fundamentals_table(driver.fundamentals_raw(spark, SF_SMALL)),
                             sectors, driver.news_source(spark, SF_SMALL), driver.sector_facts, P)
    out.collect()
    assert calls.value == docs.count()


def test_alert_report_classifies_survivors_only_when_given_a_sector_function(spark):
    from conftest import SF_SMALL
    from risingtide.operators import inference
    from risingtide.params import DRIVER_PARAMS as P
    from risingtide.sources import driver, lookups

    calls = spark.sparkContext.accumulator(0)

    def predict(records):
        calls.add(len(records))
        return inference.keyword_sector_predict(records)

    docs = driver.table(spark, SF_SMALL, "documents").selectExpr("doc_id AS symbol", "text")

    def sectors_for(keys):
        return inference.classify(docs.join(keys, "symbol", "left_semi"), predict=predict)[0]

    fund = lookups.fundamentals_table(driver.fundamentals_raw(spark, SF_SMALL))
    out = alert.alert_report(driver.prices(spark, SF_SMALL, P), fund, sectors_for,
                             driver.news_source(spark, SF_SMALL), driver.sector_facts, P)
    out.collect()
    survivors = alert.survivors(driver.prices(spark, SF_SMALL, P), fund, P)
    with_doc = survivors.join(docs, "symbol", "left_semi").count()
    assert 0 < calls.value == with_doc < docs.count()
