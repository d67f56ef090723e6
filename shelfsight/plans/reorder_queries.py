"""Paid invoices, as-of features, labels, rank metrics and reorder predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfsight.functions import net_revenue, round_half_up
from shelfsight.operators import models, reorder
from shelfsight.operators.isotonic import isotonic_fit
from shelfsight.plans.forecast_queries import _round
from shelfsight.operators.staging import stage
from shelfsight.plans.inputs import transactions, transactions_sql, with_tables
from shelfsight.plans.registry import query

_NEEDED = (
    "posting_date",
    "description",
    "distributor",
    "sales_rep",
    "canonical_code",
    "ship_to_code",
    "quantity",
    "revenue",
    "amount",
)
_HORIZON = reorder.HORIZON_DAYS
_TRAIN_START = "2000-01-01"  # training uses as-of dates from here on
_TX = dict(transactions=transactions_sql(*_NEEDED))

_INV = """inv AS (
  SELECT distributor, canonical_code AS account_id, ship_to_code, posting_date AS invoice_date,
    sum(coalesce(revenue, amount, 0)) AS revenue, sum(coalesce(quantity, 0)) AS units,
    min(description) AS product_name, min(sales_rep) AS sales_rep
  FROM transactions GROUP BY 1, 2, 3, 4 HAVING sum(coalesce(revenue, amount, 0)) > 0)"""
_PAST = """asofs AS (SELECT CAST(a AS DATE) AS asof_date FROM (
    SELECT unnest(generate_series(date_trunc('month', min(invoice_date)),
      CAST(max(invoice_date) AS TIMESTAMP), INTERVAL 1 MONTH)) AS a, min(invoice_date) AS lo
    FROM inv) t WHERE a >= lo),
past AS (
  SELECT i.*, asof_date, CAST(date_diff('day', invoice_date, asof_date) AS INTEGER) AS age
  FROM inv i JOIN asofs ON invoice_date <= asof_date WHERE account_id IS NOT NULL)"""


def _window_columns() -> str:
    parts = []
    for d in reorder.WINDOWS:
        inside = f"FILTER (WHERE age < {d})"
        parts += [
            f"count(*) {inside} AS orders_{d}d",
            f"CAST(coalesce(sum(revenue) {inside}, 0) AS DOUBLE) AS revenue_{d}d",
            f"CAST(coalesce(sum(units) {inside}, 0) AS DOUBLE) AS units_{d}d",
            f"count(DISTINCT product_name) {inside} AS product_breadth_{d}d",
            f"count(DISTINCT distributor) {inside} AS distributor_breadth_{d}d",
        ]
    return ", ".join(parts)


_WINDOWED = f"""windowed AS (
  SELECT account_id, asof_date, {_window_columns()} FROM past WHERE age < 180
  GROUP BY account_id, asof_date)"""


def _gap_sql(days: int) -> str:
    return f"""gap{days} AS (
  SELECT account_id, asof_date, median(gap) AS m, count(gap) AS n FROM (
    SELECT account_id, asof_date, date_diff('day', lag(invoice_date) OVER (
        PARTITION BY account_id, asof_date ORDER BY invoice_date), invoice_date) AS gap
    FROM past WHERE age < {days}) g
  WHERE gap IS NOT NULL GROUP BY account_id, asof_date)"""


_INTERVALS = f"""{_gap_sql(180)},
{_gap_sql(90)},
recent AS (
  SELECT account_id, asof_date, coalesce(median(gap), 0) AS m FROM (
    SELECT account_id, asof_date, date_diff('day', lag(invoice_date) OVER (
        PARTITION BY account_id, asof_date ORDER BY invoice_date), invoice_date) AS gap
    FROM (SELECT account_id, asof_date, invoice_date, row_number() OVER (
            PARTITION BY account_id, asof_date ORDER BY invoice_date DESC) AS rn
          FROM past) r
    WHERE rn <= 5) g
  GROUP BY account_id, asof_date),
intervals AS (
  SELECT r.account_id, r.asof_date, CAST(coalesce(l.m, 0) AS DOUBLE) AS median_interval_180d,
    CAST(CASE WHEN l.m IS NULL AND r.asof_date IN (SELECT asof_date FROM gap180) THEN 0
      ELSE r.m END AS DOUBLE) AS median_interval_recent5,
    CAST(coalesce(s.m, 0) AS DOUBLE) AS median_interval_90d
  FROM recent r LEFT JOIN gap180 l ON l.account_id = r.account_id AND l.asof_date = r.asof_date
  LEFT JOIN gap90 s ON s.account_id = r.account_id AND s.asof_date = r.asof_date)"""
_LABELS = f"""labelled AS (
  SELECT p.account_id, p.asof_date,
    CAST(coalesce(max(CASE WHEN f.invoice_date > p.asof_date
      AND f.invoice_date <= p.asof_date + {_HORIZON} THEN 1 ELSE 0 END), 0) AS INTEGER) AS label,
    p.asof_date + {_HORIZON} <= (SELECT max(invoice_date) FROM inv) AS label_complete
  FROM (SELECT DISTINCT account_id, asof_date FROM past) p
  LEFT JOIN inv f ON f.account_id = p.account_id
  GROUP BY p.account_id, p.asof_date)"""

_NUMBERS = [f for f in reorder.FEATURES if f.endswith("d") and f[-2].isdigit() and "median" not in f]
_COUNTED = ", ".join(f"CAST(coalesce(w.{c}, 0) AS DOUBLE) AS {c}" for c in _NUMBERS)
_FEATURES = f"""joined AS (
  SELECT s.account_id, s.asof_date, CAST(s.age AS DOUBLE) AS days_since_last, {_COUNTED},
    i.median_interval_180d, i.median_interval_recent5, i.median_interval_90d,
    sin(month(s.last_date) / 12.0e0 * (2 * pi())) AS sin_month,
    cos(month(s.last_date) / 12.0e0 * (2 * pi())) AS cos_month
  FROM (SELECT account_id, asof_date, min(age) AS age, max(invoice_date) AS last_date
        FROM past GROUP BY 1, 2) s
  JOIN intervals i ON i.account_id = s.account_id AND i.asof_date = s.asof_date
  LEFT JOIN windowed w ON w.account_id = s.account_id AND w.asof_date = s.asof_date),
cycled AS (
  SELECT *, CASE WHEN median_interval_recent5 > 0 THEN days_since_last / median_interval_recent5
      WHEN median_interval_180d > 0 THEN days_since_last / median_interval_180d
      ELSE 0 END AS cycle,
    CASE WHEN median_interval_recent5 > 0 AND median_interval_180d > 0
      THEN median_interval_180d / median_interval_recent5 ELSE 1 END AS velocity_trend
  FROM joined),
features AS (
  SELECT * EXCLUDE (cycle, sin_month, cos_month),
    {_round('sin_month', 6)} AS sin_month, {_round('cos_month', 6)} AS cos_month,
    CASE WHEN orders_180d = 1 THEN 999 ELSE cycle END AS days_into_cycle,
    CASE WHEN orders_180d = 1 THEN 999 ELSE cycle * cycle END AS overdue_severity,
    CAST(cycle > 2 AS DOUBLE) AS is_severely_overdue,
    CAST(orders_90d >= 8 AS DOUBLE) AS is_high_frequency,
    CAST(cycle > 2 AND orders_90d >= 8 AS DOUBLE) AS high_freq_overdue,
    CAST(orders_180d = 1 AS DOUBLE) AS is_one_time_buyer
  FROM cycled)"""


def _invoices(spark, sf, texts=("product_name", "sales_rep")):
    lines = transactions(spark, sf, *_NEEDED).select(
        "distributor",
        "canonical_code",
        "ship_to_code",
        "posting_date",
        net_revenue().alias("revenue"),
        "quantity",
        F.col("description").alias("product_name"),
        "sales_rep",
    )
    return reorder.paid_invoices(lines.drop(*{"product_name", "sales_rep"}.difference(texts)))


def _written_invoices(spark, sf, features=reorder.FEATURES):
    """Invoices written out once, since several branches of a plan read them.

    Only what the features and labels come from is written, and texts that none of them needs
    take no part in the grouping.
    """
    columns = reorder.invoice_columns(features)
    texts = [c for c in ("product_name",) if c in columns]
    return stage(_invoices(spark, sf, texts).select(columns))


def _calendar(invoices):
    """The month starts that the invoices cover; one row per month reaches the driver."""
    days = reorder.asof_calendar(invoices, day="invoice_date").collect()
    return [row.asof_date for row in days]


def _comparable(features):
    return features.withColumns(
        {c: round_half_up(F.col(c), 6) for c in ("sin_month", "cos_month")}
    )


@query(
    "paid_invoices",
    with_tables(
        "SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue, CAST(units AS DOUBLE) AS units)"
        " FROM inv",
        _INV,
        **_TX,
    ),
)
def paid_invoices(spark, sf):
    return _invoices(spark, sf)


@query(
    "asof_calendar",
    with_tables(
        """SELECT CAST(a AS DATE) AS asof_date FROM (
          SELECT unnest(generate_series(date_trunc('month', min(posting_date)),
            CAST(max(posting_date) AS TIMESTAMP), INTERVAL 1 MONTH)) AS a,
            min(posting_date) AS lo FROM transactions) t WHERE a >= lo""",
        transactions=transactions_sql("posting_date"),
    ),
)
def asof_calendar(spark, sf):
    return reorder.asof_calendar(transactions(spark, sf, "posting_date"))


@query(
    "split_calendar",
    with_tables(
        """SELECT DATE '2000-01-01' AS train_start, e - 107 AS train_end, e - 106 AS valid_start,
          e - 61 AS valid_end, e - 60 AS test_start, e AS test_end
        FROM (SELECT max(posting_date) AS e FROM transactions) t""",
        transactions=transactions_sql("posting_date"),
    ),
)
def split_calendar(spark, sf):
    return reorder.split_calendar(transactions(spark, sf, "posting_date"), "2000-01-01")


@query(
    "churn_window_features", with_tables("SELECT * FROM windowed", _INV, _PAST, _WINDOWED, **_TX)
)
def churn_window_features(spark, sf):
    invoices = _written_invoices(spark, sf)
    return reorder.churn_window_features(invoices, _calendar(invoices))


@query(
    "reorder_intervals", with_tables("SELECT * FROM intervals", _INV, _PAST, _INTERVALS, **_TX)
)
def reorder_intervals(spark, sf):
    invoices = _written_invoices(spark, sf, ())
    return reorder.reorder_intervals(invoices, _calendar(invoices))


@query("churn_labels", with_tables("SELECT * FROM labelled", _INV, _PAST, _LABELS, **_TX))
def churn_labels(spark, sf):
    invoices = _written_invoices(spark, sf, ())
    return reorder.churn_labels(invoices, _calendar(invoices), _HORIZON)


_ALL = (_INV, _PAST, _WINDOWED, _INTERVALS, _FEATURES)


@query("churn_features", with_tables("SELECT * FROM features", *_ALL, **_TX))
def churn_features(spark, sf):
    invoices = _written_invoices(spark, sf)
    return _comparable(reorder.churn_features(invoices, _calendar(invoices)))


@query(
    "churn_dataset",
    with_tables(
        """SELECT f.*, l.label, l.label_complete FROM features f
        JOIN labelled l ON l.account_id = f.account_id AND l.asof_date = f.asof_date""",
        *_ALL,
        _LABELS,
        **_TX,
    ),
)
def churn_dataset(spark, sf):
    return _comparable(_dataset(spark, sf))


def _dataset(spark, sf, features=reorder.FEATURES):
    invoices = _written_invoices(spark, sf, features)
    return reorder.churn_dataset(invoices, _calendar(invoices), _HORIZON, features=features)


# a score that ranks: recent orders against time since the last one, ties included
_SCORED_BY = ("orders_90d", "days_since_last")
_SCORED = f"""scored AS (
  SELECT l.label, {_round("f.orders_90d / (1 + f.days_since_last)", 4)} AS score
  FROM features f JOIN labelled l ON l.account_id = f.account_id AND l.asof_date = f.asof_date
  WHERE l.label_complete)"""


@query(
    "rank_metrics",
    with_tables(
        f"""SELECT p AS positives, n AS negatives,
          CASE WHEN p > 0 AND n > 0 THEN {_round("1 - area / (CAST(p AS DOUBLE) * n)", 6)} END AS auc,
          CASE WHEN p > 0 AND n > 0 THEN {_round("ap / p", 6)} END AS pr_auc
        FROM (SELECT CAST(sum(pos) AS BIGINT) AS p, CAST(sum(neg) AS BIGINT) AS n,
            sum(pos * (fp - neg / 2.0e0)) AS area,
            sum(pos * (CAST(tp AS DOUBLE) / (tp + fp))) AS ap
          FROM (SELECT pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp,
              sum(neg) OVER (ORDER BY score DESC) AS fp
            FROM (SELECT score, sum(label) AS pos, sum(1 - label) AS neg
              FROM scored GROUP BY score) t) c) s""",
        *_ALL,
        _LABELS,
        _SCORED,
        **_TX,
    ),
)
def rank_metrics(spark, sf):
    dataset = _dataset(spark, sf, _SCORED_BY).where("label_complete")
    score = round_half_up(F.col("orders_90d") / (1 + F.col("days_since_last")), 4)
    metrics = models.rank_metrics(dataset.select("label", score.alias("score")))
    return metrics.withColumns(
        {c: round_half_up(F.col(c), 6) for c in ("auc", "pr_auc")}
    )


@query(
    "calibration_fit",
    with_tables(
        f"""SELECT x AS score, weight, {_round("max(least_above)", 6)} AS calibrated FROM (
          SELECT i.x, i.weight, j.n AS low, min((k.sy - j.sy + j.y) / (k.sw - j.sw + j.weight)) AS least_above
          FROM pooled i JOIN pooled j ON j.n <= i.n JOIN pooled k ON k.n >= i.n
          GROUP BY i.x, i.weight, j.n) m
        GROUP BY x, weight""",
        *_ALL,
        _LABELS,
        _SCORED,
        """pooled AS (SELECT x, weight, y, n, sum(y) OVER (ORDER BY n) AS sy,
            sum(weight) OVER (ORDER BY n) AS sw
          FROM (SELECT score AS x, CAST(count(*) AS DOUBLE) AS weight,
              CAST(sum(label) AS DOUBLE) AS y, row_number() OVER (ORDER BY score) AS n
            FROM scored GROUP BY score) g)""",
        **_TX,
    ),
)
def calibration_fit(spark, sf):
    """Isotonic fit of the label on a fixed score, checked by the max-min formula."""
    dataset = _dataset(spark, sf, _SCORED_BY).where("label_complete")
    score = round_half_up(F.col("orders_90d") / (1 + F.col("days_since_last")), 4)
    fitted = isotonic_fit(dataset.select("label", score.alias("score")))
    return fitted.withColumn("calibrated", round_half_up(F.col("calibrated"), 6))


_STATS = ", ".join(f"stddev_samp({f}) AS {f}" for f in reorder.FEATURES)


@query(
    "feature_scaling",
    with_tables(
        f"""SELECT feature, {_round("deviation", 6)} AS deviation,
          n / (2.0e0 * (n - positives)) AS weight_0, n / (2.0e0 * positives) AS weight_1
        FROM (UNPIVOT (SELECT {_STATS} FROM features) ON COLUMNS(*) INTO NAME feature VALUE deviation) u,
          (SELECT count(*) AS n, count(*) FILTER (WHERE label = 1) AS positives FROM labelled) c""",
        *_ALL,
        _LABELS,
        **_TX,
    ),
)
def feature_scaling(spark, sf):
    """What the scaler and the class weights learn, one row per feature."""
    dataset = stage(_comparable(_dataset(spark, sf)))
    weights = models.class_weights(dataset)
    scaler = models.fit_scaler(models.assembled(dataset, reorder.FEATURES))
    rows = list(zip(reorder.FEATURES, (float(v) for v in scaler.std), strict=True))
    return spark.createDataFrame(rows, "feature string, deviation double").select(
        "feature",
        round_half_up(F.col("deviation"), 6).alias("deviation"),
        F.lit(weights[0]).alias("weight_0"),
        F.lit(weights[1]).alias("weight_1"),
    )


_DIAGNOSED = ", ".join(models.DIAGNOSTICS)


@query(
    "churn_predictions",
    with_tables(
        f"SELECT {_DIAGNOSED}, true AS has_probability FROM features",
        _INV,
        """past AS (
          SELECT i.*, asof_date, CAST(date_diff('day', invoice_date, asof_date) AS INTEGER) AS age
          FROM inv i JOIN (SELECT max(invoice_date) AS asof_date FROM inv) d
            ON invoice_date <= asof_date WHERE account_id IS NOT NULL)""",
        _WINDOWED,
        _INTERVALS,
        _FEATURES,
        **_TX,
    ),
)
def churn_predictions(spark, sf):
    """Trained up to the validation period, scored at the last day of the data.

    The probability itself depends on the forest's random draws, so the query says of each
    account that it has one between 0 and 1.
    """
    invoices = _written_invoices(spark, sf)
    days = reorder.split_calendar(invoices, _TRAIN_START, day="invoice_date").first()
    training, valid = (
        reorder.asof_dates(days[f"{split}_start"], days[f"{split}_end"]) for split in ("train", "valid")
    )
    # accounts are put in order once for all three tables
    history = reorder.shared_history(invoices, [*training, *valid, days["test_end"]])

    def dataset(dates):
        return reorder.churn_dataset(invoices, dates, _HORIZON, history=history)

    fitted = models.train_reorder_models(dataset(training), dataset(valid), reorder.FEATURES)
    latest = reorder.churn_features(invoices, [days["test_end"]], history=history)
    predicted = models.churn_predictions(fitted, latest, _HORIZON)
    probability = F.col(f"risk_prob_reorder_{_HORIZON}d")
    return predicted.select(
        *models.DIAGNOSTICS,
        F.coalesce(probability.between(0, 1), F.lit(False)).alias("has_probability"),
    )
