"""Monthly series per key, gap filling, routing and projection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from shelfsight.functions import net_revenue, round_half_up
from shelfsight.operators import series
from shelfsight.plans.forecast_queries import _round
from shelfsight.plans.inputs import transactions, transactions_sql, with_tables
from shelfsight.plans.registry import query

_NEEDED = (
    "posting_date", "description", "brand", "distributor", "sales_rep", "revenue", "amount",
)
_TX = dict(transactions=transactions_sql(*_NEEDED))
_LINES = """sold AS (
  SELECT posting_date, description || ' ' || brand AS product_name, distributor, sales_rep,
    coalesce(revenue, amount, 0) AS revenue FROM transactions)"""


def _lines(spark, sf):
    return transactions(spark, sf, *_NEEDED).select(
        "posting_date",
        F.concat_ws(" ", "description", "brand").alias("product_name"),
        "distributor",
        "sales_rep",
        net_revenue().alias("revenue"),
    )


def _monthly_sql(group: str) -> str:
    keys = ", ".join(series.GROUPS[group])
    return f"""SELECT {keys}, CAST(date_trunc('month', posting_date) AS DATE) AS month,
      sum(revenue) AS revenue FROM sold GROUP BY ALL"""


def _label_sql(group: str) -> str:
    joint = "' | rep:'" if group == "product_rep" else "' | '"
    return f" || {joint} || ".join(series.GROUPS[group])


@query(
    "monthly_by_key",
    with_tables(
        " UNION ALL ".join(
            f"""SELECT '{g}' AS key_type, {_label_sql(g)} AS key_id, month,
              CAST(revenue AS DOUBLE) AS revenue FROM ({_monthly_sql(g)}) m_{g}"""
            for g in series.GROUPS
        ),
        _LINES,
        **_TX,
    ),
)
def monthly_by_key(spark, sf):
    """All five cuts, each from the same finest sums so that the lines are read once."""
    return _cuts(_finest(spark, sf))


def _finest(spark, sf):
    return (
        _lines(spark, sf)
        .groupBy("product_name", "distributor", "sales_rep", F.trunc("posting_date", "MM").alias("posting_date"))
        .agg(F.sum("revenue").alias("revenue"))
    )


def _cuts(lines, paid_only=False):
    cuts = [
        series.monthly_by_key(lines, g, paid_only=paid_only).select(
            F.lit(g).alias("key_type"),
            series.key_label(g).alias("key_id"),
            "month",
            F.col("revenue").cast("double").alias("revenue"),
        )
        for g in series.GROUPS
    ]
    return reduce(lambda a, b: a.unionByName(b), cuts)


@query(
    "monthly_by_key_paid",
    with_tables(
        " UNION ALL ".join(
            f"""SELECT '{g}' AS key_type, {_label_sql(g)} AS key_id, month,
              CAST(revenue AS DOUBLE) AS revenue FROM ({_monthly_sql(g)}) m_{g}"""
            for g in series.GROUPS
        ),
        _LINES + ", all_sold AS (SELECT * FROM sold WHERE revenue > 0)",
        **_TX,
    ).replace("FROM sold GROUP", "FROM all_sold GROUP"),
)
def monthly_by_key_paid(spark, sf):
    """The same over lines with positive revenue only."""
    return _cuts(_lines(spark, sf), paid_only=True)


def _fill_sql(source: str, keys: str) -> str:
    on = " AND ".join(f"s.{k} IS NOT DISTINCT FROM k.{k}" for k in keys.split(", "))
    picked = ", ".join(f"k.{k}" for k in keys.split(", "))
    return f"""SELECT {picked}, k.month, coalesce(s.revenue, 0) AS revenue
      FROM (SELECT {keys}, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP),
              CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month
            FROM (SELECT {keys}, min(month) AS lo, max(month) AS hi
                  FROM {source} GROUP BY {keys}) r) k
      LEFT JOIN {source} s ON {on} AND s.month = k.month"""


_PAIRS = f"pairs AS ({_monthly_sql('product_distributor')})"


def _pairs(spark, sf):
    return series.monthly_by_key(_lines(spark, sf), "product_distributor")


@query(
    "monthly_gapfill",
    with_tables(
        f"""SELECT product_name, distributor, month, CAST(revenue AS DOUBLE) AS revenue
        FROM ({_fill_sql('pairs', 'product_name, distributor')}) f""",
        _LINES,
        _PAIRS,
        **_TX,
    ),
)
def monthly_gapfill(spark, sf):
    return series.monthly_gapfill(_pairs(spark, sf), ["product_name", "distributor"])


_ROUTES = """rolled AS (
  SELECT product_name, month, sum(revenue) AS revenue FROM pairs GROUP BY ALL),
routes AS (
  SELECT p.product_name, p.distributor, p.n AS positive_months, r.n AS product_positive_months,
    CASE WHEN p.n >= 3 THEN 'direct' WHEN r.n >= 3 THEN 'rollup' ELSE 'skip' END AS route
  FROM (SELECT product_name, distributor, count(*) FILTER (WHERE revenue > 0) AS n
        FROM pairs GROUP BY ALL) p
  LEFT JOIN (SELECT product_name, count(*) FILTER (WHERE revenue > 0) AS n
        FROM rolled GROUP BY ALL) r ON r.product_name = p.product_name)"""


@query(
    "forecast_series_routing",
    with_tables("SELECT * FROM routes", _LINES, _PAIRS, _ROUTES, **_TX),
)
def forecast_series_routing(spark, sf):
    return series.forecast_series_routing(_pairs(spark, sf))


def _forecast_sql(source: str, keys: str, group: str) -> str:
    """Ordinary least squares per key, seasonal means of the residuals, and a 95 % band."""
    over = f"PARTITION BY {keys}"
    return f"""SELECT '{group}' AS key_type, {_label_sql(group)} AS key_id,
      CAST(last_month + to_months(h) AS DATE) AS date, {_round('yhat')} AS yhat,
      {_round('yhat - 1.96e0 * sigma')} AS yhat_lower,
      {_round('yhat + 1.96e0 * sigma')} AS yhat_upper, 'trend_seasonal' AS model
    FROM (
      SELECT {keys}, last_month, sigma, h, intercept + slope * (n - 1 + h) + coalesce(
          effects[month(CAST(last_month + to_months(h) AS DATE))], 0) AS yhat
      FROM (
        SELECT {keys}, max(n) AS n, max(slope) AS slope, max(intercept) AS intercept,
          max(last_month) AS last_month,
          coalesce(stddev_samp(CAST(revenue AS DOUBLE) - (intercept + slope * t) - effect), 0)
            AS sigma,
          map_from_entries(list(DISTINCT {{'k': mo, 'v': effect}})) AS effects
        FROM (
          SELECT *, CASE WHEN n >= 24 THEN
              (CAST(sy_m AS DOUBLE) - (intercept * n_m + slope * st_m)) / n_m ELSE 0 END AS effect
          FROM (
            SELECT *, (sy - slope * st) / n AS intercept FROM (
              SELECT *, (n * sty - st * sy) / (n * stt - st * st) AS slope FROM (
                SELECT {keys}, month, revenue, t, mo, CAST(count(*) OVER ({over}) AS DOUBLE) AS n,
                  CAST(sum(t) OVER ({over}) AS DOUBLE) AS st,
                  CAST(sum(t * t) OVER ({over}) AS DOUBLE) AS stt,
                  CAST(sum(revenue) OVER ({over}) AS DOUBLE) AS sy,
                  CAST(sum(t * revenue) OVER ({over}) AS DOUBLE) AS sty,
                  max(month) OVER ({over}) AS last_month,
                  CAST(count(*) OVER ({over}, mo) AS DOUBLE) AS n_m,
                  CAST(sum(t) OVER ({over}, mo) AS DOUBLE) AS st_m,
                  sum(revenue) OVER ({over}, mo) AS sy_m
                FROM (SELECT *, month(month) AS mo,
                    row_number() OVER ({over} ORDER BY month) - 1 AS t
                  FROM ({_fill_sql(source, keys)}) g) u) s
              WHERE n > 1) f) i) e
        GROUP BY {keys}) p
      CROSS JOIN (SELECT unnest(range(1, 13)) AS h) steps) y"""


_CUT = "2002-06-01"  # forecasts after this month are dropped


_OTHERS = tuple(g for g in series.GROUPS if g != "product_distributor")


@query(
    "sales_forecast",
    with_tables(
        f"""SELECT * FROM ({_forecast_sql('chosen', 'product_name, distributor', 'product_distributor')})
          WHERE date <= DATE '{_CUT}'"""
        + "".join(
            f""" UNION ALL SELECT * FROM ({_forecast_sql(f'by_{g}', ', '.join(series.GROUPS[g]), g)})
          WHERE date <= DATE '{_CUT}'"""
            for g in _OTHERS
        ),
        _LINES,
        _PAIRS,
        _ROUTES,
        *(f"by_{g} AS ({_monthly_sql(g)})" for g in _OTHERS),
        """chosen AS (
          SELECT p.product_name, p.distributor, p.month, p.revenue FROM pairs p
          JOIN routes r ON r.product_name = p.product_name AND r.distributor = p.distributor
          WHERE r.route = 'direct'
          UNION ALL
          SELECT product_name, 'ALL', month, revenue FROM rolled
          WHERE product_name IN (SELECT product_name FROM routes WHERE route = 'rollup'))""",
        **_TX,
    ),
)
def sales_forecast(spark, sf):
    """All five modes, each from the same finest monthly sums."""
    fine = _finest(spark, sf)
    parts = [
        series.sales_forecast(series.monthly_by_key(fine, group), group, cutoff=_CUT).select(
            "key_type",
            "key_id",
            "date",
            *(round_half_up(F.col(c), 2).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")),
            "model",
        )
        for group in series.GROUPS
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
