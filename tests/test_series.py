import datetime as dt

from shelfsight.operators import series

D = dt.date


def month(i):
    return D(2022 + i // 12, i % 12 + 1, 1)


def monthly(spark, rows):
    return spark.createDataFrame(
        rows, "product_name string, distributor string, month date, revenue double"
    ).selectExpr("product_name", "distributor", "month", "CAST(revenue AS DECIMAL(18,2)) AS revenue")


def test_months_without_a_date_are_left_out_and_paid_only(spark):
    lines = spark.createDataFrame(
        [(D(2022, 1, 5), "p", 5.0), (D(2022, 1, 9), "p", -2.0), (D(2022, 1, 9), "p", None),
         (None, "p", 9.0)],
        "posting_date date, product_name string, revenue double",
    )
    assert [tuple(r) for r in series.monthly_by_key(lines, "product").collect()] == [
        ("p", month(0), 3.0)]
    paid = series.monthly_by_key(lines, "product", paid_only=True).first()
    assert paid.revenue == 5.0


def test_gapfill(spark):
    df = monthly(spark, [("p", "d", month(0), 1.0), ("p", "d", month(3), 4.0), (None, "d", month(5), 7.0)])
    rows = series.monthly_gapfill(df, ["product_name", "distributor"]).collect()
    got = sorted((r.product_name or "", r.month, float(r.revenue)) for r in rows)
    assert got == [("", month(5), 7.0), ("p", month(0), 1.0), ("p", month(1), 0.0),
                   ("p", month(2), 0.0), ("p", month(3), 4.0)]


def test_routing_and_one_rollup_per_product(spark):
    rows = [("dense", "a", month(i), 5.0) for i in range(4)]
    rows += [("mixed", "a", month(i), 5.0) for i in range(2)]
    rows += [("mixed", "b", month(i), 5.0) for i in range(2, 4)]
    rows += [("rare", "a", month(0), 5.0), ("rare", "b", month(0), -5.0)]
    df = monthly(spark, rows)
    routes = {(r.product_name, r.distributor): r.route
              for r in series.forecast_series_routing(df).collect()}
    assert routes == {("dense", "a"): "direct", ("mixed", "a"): "rollup",
                      ("mixed", "b"): "rollup", ("rare", "a"): "skip", ("rare", "b"): "skip"}
    forecast = series.sales_forecast(df, "product_distributor", steps=2)
    assert sorted((r.key_id, r.date) for r in forecast.collect()) == [
        ("dense | a", month(4)), ("dense | a", month(5)),
        ("mixed | ALL", month(4)), ("mixed | ALL", month(5)),
    ]


def test_straight_line_is_continued_and_cut(spark):
    df = monthly(spark, [("p", "d", month(i), 100.0 + 10 * i) for i in range(30)])
    out = series.sales_forecast(df.drop("distributor"), "product", cutoff=month(32)).collect()
    got = sorted((r.date, round(r.yhat, 6), round(r.yhat_upper - r.yhat_lower, 6)) for r in out)
    assert got == [(month(i), 100.0 + 10 * i, 0.0) for i in (30, 31, 32)]
    assert {r.key_type for r in out} == {"product"} and {r.model for r in out} == {"trend_seasonal"}


def test_season_repeats_only_with_two_years(spark):
    # July is high: with 36 months the next July must be higher than its neighbours
    def values(n):
        return [("p", "d", month(i), 500.0 if i % 12 == 6 else 100.0) for i in range(n)]

    def by_month(n):
        df = monthly(spark, values(n)).drop("distributor")
        return {r.date.month: r.yhat for r in series.sales_forecast(df, "product").collect()}

    long, short = by_month(36), by_month(12)
    assert long[7] > long[6] + 300 and abs(short[7] - short[6]) < 50


def test_single_month_has_no_forecast(spark):
    df = monthly(spark, [("p", "d", month(0), 5.0)]).drop("distributor")
    assert series.sales_forecast(df, "product").count() == 0
