"""Paid invoices, and what was known about each account on given as-of dates.

The as-of dates are a short list, so an invoice finds the dates it matters to by a slice
of that list on its own row. Nothing is joined on a date range, and no row is paired with
a date it does not contribute to.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.functions.dates import as_date, month_number
from shelfsight.operators.staging import stage

WINDOWS = (30, 90, 180)
GAP_WINDOWS = (90, 180)
RECENT_INVOICES = 5
HORIZON_DAYS = 60
TEST_DAYS = 60
VALIDATION_DAYS = 45
HIGH_FREQUENCY_ORDERS = 8
OVERDUE_CYCLES = 2.0
NO_HISTORY = 999.0

FEATURES = (
    "days_since_last",
    *(
        f"{measure}_{days}d"
        for days in WINDOWS
        for measure in (
            "orders",
            "revenue",
            "units",
            "product_breadth",
            "distributor_breadth",
        )
    ),
    "median_interval_180d",
    "median_interval_recent5",
    "median_interval_90d",
    "sin_month",
    "cos_month",
    "days_into_cycle",
    "velocity_trend",
    "overdue_severity",
    "is_severely_overdue",
    "is_high_frequency",
    "high_freq_overdue",
    "is_one_time_buyer",
)

#: The features that need the median of the last few invoices.
_BY_INTERVAL = (
    "median_interval_recent5",
    "days_into_cycle",
    "velocity_trend",
    "overdue_severity",
    "is_severely_overdue",
    "high_freq_overdue",
)

AsOf = Sequence[dt.date | str]

MEASURES = ("revenue", "units")
_FACETS = {"distributor": "distributor", "product_name": "product"}
#: As-of dates that share a number of one bit each; fewer than 63, so that none is its sign.
_STRETCH = 60


def asof_dates(lo: dt.date | str, hi: dt.date | str) -> list[dt.date]:
    """Month starts in ``[lo, hi]``."""
    lo, hi = (dt.date.fromisoformat(str(d)) for d in (lo, hi))
    months = range(12 * lo.year + lo.month - 1, 12 * hi.year + hi.month)
    starts = (dt.date(m // 12, m % 12 + 1, 1) for m in months)
    return [day for day in starts if lo <= day <= hi]


def asof_calendar(tx: DataFrame, lo=None, hi=None, day: str = "posting_date") -> DataFrame:
    """The month starts between the first and last day of the data, or of ``[lo, hi]``."""
    first = F.min(day) if lo is None else as_date(lo)
    last = F.max(day) if hi is None else as_date(hi)
    month = F.trunc("first", "MM")
    start = F.when(month == F.col("first"), month).otherwise(F.add_months(month, 1))
    bounds = tx.agg(first.alias("first"), last.alias("last"))
    return bounds.where(start <= F.col("last")).select(
        F.explode(F.sequence(start, F.col("last"), F.expr("INTERVAL 1 MONTH"))).alias("asof_date")
    )


def split_calendar(tx: DataFrame, train_start: dt.date | str, day: str = "posting_date") -> DataFrame:
    """Train, validation and test dates counted back from the last day of the data."""
    latest = F.col("latest")
    valid_end = TEST_DAYS + 1
    valid_start = valid_end + VALIDATION_DAYS
    return tx.agg(F.max(day).alias("latest")).select(
        as_date(train_start).alias("train_start"),
        F.date_sub(latest, valid_start + 1).alias("train_end"),
        F.date_sub(latest, valid_start).alias("valid_start"),
        F.date_sub(latest, valid_end).alias("valid_end"),
        F.date_sub(latest, TEST_DAYS).alias("test_start"),
        latest.alias("test_end"),
    )


def paid_invoices(
    lines: DataFrame,
    *,
    distributor: str = "distributor",
    account: str = "canonical_code",
    ship_to: str = "ship_to_code",
    day: str = "posting_date",
    revenue: str = "revenue",
    quantity: str = "quantity",
    product: str = "product_name",
    sales_rep: str = "sales_rep",
) -> DataFrame:
    """Lines grouped into invoices, keeping those with positive revenue.

    NULL keys form invoices of their own. Columns other than the account and the day may
    be missing. Lines of an invoice have no order, so its product and rep are the
    smallest ones.
    """
    if account not in lines.columns:
        raise ValueError(f"account column {account!r} not found")
    names = {distributor: "distributor", account: "account_id", ship_to: "ship_to_code"}
    keys = [F.col(c).alias(name) for c, name in names.items() if c in lines.columns]

    def total(column: str) -> Column:
        if column not in lines.columns:
            return F.lit(0.0)
        return F.sum(F.coalesce(column, F.lit(0)))

    passed = {product: "product_name", sales_rep: "sales_rep"}
    texts = [F.col(c).alias(name) for c, name in passed.items() if c in lines.columns]
    # first by the texts as well: sums over plain keys are hash aggregates that combine before
    # the shuffle, so an invoice of very many lines moves as few rows; the texts' minima, which
    # need sorting, then see one row per text and, dealt out first, are sorted once
    by_text = lines.groupBy(*keys, F.col(day).alias("invoice_date"), *texts).agg(
        total(revenue).alias("revenue"), total(quantity).alias("units")
    )
    names_kept = [c for c in by_text.columns if c not in (*passed.values(), "revenue", "units")]
    if not texts:  # these are the invoices already; the types are those of the second level
        summed = by_text.agg(F.sum("revenue").alias("revenue"), F.sum("units").alias("units")).schema
        return by_text.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in summed}).where(F.col("revenue") > 0)
    # accounts tell rows apart by their first letters, so that sorting compares few whole keys
    first = [c for c in ("account_id", "invoice_date") if c in names_kept]
    return (
        by_text.repartition(*names_kept)
        .groupBy(*first, *(c for c in names_kept if c not in first))
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("units").alias("units"),
            *(F.min(name).alias(name) for c, name in passed.items() if c in lines.columns),
        )
        .select(*names_kept, "revenue", "units", *(name for c, name in passed.items() if c in lines.columns))
        .where(F.col("revenue") > 0)
    )


def _usable(invoices: DataFrame) -> DataFrame:
    return invoices.where(F.col("account_id").isNotNull() & F.col("invoice_date").isNotNull())


def _dealt(invoices: DataFrame) -> DataFrame:
    """Usable invoices, each account's in one place, so that nothing after it has to move."""
    return _usable(invoices).repartition("account_id")


def _sorted_dates(asofs: AsOf) -> list[dt.date]:
    days = sorted({dt.date.fromisoformat(str(d)) for d in asofs})
    if not days:
        raise ValueError("no as-of dates given")
    return days


def _count_before(days: list[dt.date], day: Column) -> Column:
    """How many as-of dates lie before ``day``.

    Arithmetic for an unbroken run of month starts, a sum of comparisons otherwise; both
    compile to plain code, unlike a lambda over the list.
    """
    if days == asof_dates(days[0], days[-1]):
        started = F.when(F.dayofmonth(day) > 1, 1).otherwise(0)
        origin = 12 * days[0].year + days[0].month - 1
        months = month_number(day) - origin + started
        return F.greatest(F.lit(0), F.least(months, F.lit(len(days)))).cast("int")
    return reduce(lambda a, b: a + b, [(as_date(d) < day).cast("int") for d in days])


def _dates_from(days: list[dt.date], first: Column, end: Column) -> Column:
    """The as-of dates in ``[first, end)``; an open end takes all later ones."""
    before = _count_before(days, first)
    until = F.coalesce(_count_before(days, end), F.lit(len(days)))
    listed = F.array(*(as_date(d) for d in days))
    return F.slice(listed, before + 1, F.greatest(until - before, F.lit(0)))


def _covering(asofs: AsOf, days: int) -> Column:
    """The as-of dates whose window of ``days`` holds the row's invoice date."""
    day = F.col("invoice_date")
    return _dates_from(_sorted_dates(asofs), day, F.date_add(day, days))


def _with_inside(dated: DataFrame) -> DataFrame:
    """Per window, as ``inside_<days>``, the days of ``recent_days`` that it holds at ``asof_date``."""
    source = "recent_days"
    for width in sorted(WINDOWS, reverse=True):  # a shorter window looks through the longer one's
        dated = dated.withColumn(f"inside_{width}", _inside(F.col("asof_date"), F.col(source), width))
        source = f"inside_{width}"
    return dated


def _window_sums(kinds: dict) -> dict[str, Column]:
    """Orders, revenue and units per window, from the days inside it."""
    sums = {}
    for width in WINDOWS:
        inside = F.col(f"inside_{width}")
        sums[f"orders_{width}d"] = _total(inside["n"], "bigint")
        for measure in kinds.keys() & set(MEASURES):
            sums[f"{measure}_{width}d"] = _total(inside[measure], kinds[measure])
    return sums


def _inside(asof: Column, days: Column, width: int) -> Column:
    return F.filter(days, lambda d: F.datediff(asof, d["day"]) < width)


def _total(values: Column, kind) -> Column:
    zero = F.lit(0).cast(kind)
    return F.aggregate(values, zero, lambda a, v: (a + F.coalesce(v, zero)).cast(kind))


def _breadths(invoices: DataFrame, asofs: AsOf, facets: Sequence[str]) -> DataFrame:
    """Distinct values of each facet per account, date and window.

    A row per account, value and stretch of ``_STRETCH`` dates says by one bit per date whether
    the value occurs in the window, so it does not matter how many invoices it has or how many
    dates they count for. Invoices move once, to their account; bits are made and counted there.
    """
    listed = _sorted_dates(asofs)
    day = F.col("invoice_date")
    entries = [F.struct(F.lit(i).alias("facet"), F.col(c).cast("string").alias("value")) for i, c in enumerate(facets)]
    ends = {f"end_{w}": _count_before(listed, F.date_add(day, w)) for w in WINDOWS}
    longest = F.col(f"end_{max(WINDOWS)}")
    stretches = F.sequence(
        F.floor(F.col("first") / _STRETCH).cast("int"), F.floor((longest - 1) / _STRETCH).cast("int")
    )
    spans = (
        _dealt(invoices)
        .select("account_id", *facets, _count_before(listed, day).alias("first"),
                *(end.alias(name) for name, end in ends.items()))
        .where(F.col("first") < longest)
        .select("account_id", "first", *ends, F.inline(F.array(*entries)))
        .where("value IS NOT NULL")
        .select("*", F.explode(stretches).alias("stretch"))
    )

    def place(date: Column) -> Column:
        return F.least(F.greatest(date - F.col("stretch") * _STRETCH, F.lit(0)), F.lit(_STRETCH))

    def upto(date: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), place(date)) - 1

    bits = spans.groupBy("account_id", "facet", "value", "stretch").agg(
        F.min(place(F.col("first"))).alias("lo"),
        F.max(place(longest)).alias("hi"),
        *(F.bit_or(upto(F.col(f"end_{w}")).bitwiseXOR(upto(F.least("first", f"end_{w}")))).alias(f"in_{w}")
          for w in WINDOWS),
    )
    dated = bits.select(
        "account_id", "facet", (F.col("stretch") * _STRETCH).alias("begin"), *(f"in_{w}" for w in WINDOWS),
        F.explode(F.sequence(F.col("lo"), F.col("hi") - 1)).alias("at"),
    )
    counts = []
    for w in WINDOWS:
        bit = F.call_function("shiftright", F.col(f"in_{w}"), F.col("at")).bitwiseAND(F.lit(1).cast("bigint"))
        counts += [
            F.sum(F.when(F.col("facet") == i, bit).otherwise(0)).alias(f"{_FACETS[c]}_breadth_{w}d")
            for i, c in enumerate(facets)
        ]
    number = (F.col("begin") + F.col("at")).alias("number")
    counted = dated.groupBy("account_id", number).agg(*counts)
    date = F.get(F.array(*(as_date(d) for d in listed)), F.col("number"))
    return counted.select("account_id", date.alias("asof_date"), *counted.columns[2:])


def _with_breadths(days: DataFrame, invoices: DataFrame, asofs: AsOf) -> DataFrame:
    """Account days with ``breadths``: those at each date that the day stands for, in order.

    Both sides lie by account, so only the account's breadths meet its days and no row per
    account and date has to move. NULL stands where a window holds no value.
    """
    facets = [c for c in _FACETS if c in invoices.columns]
    if not facets:
        return days
    counted = _breadths(invoices, asofs, facets)
    entry = F.struct("asof_date", F.struct(*counted.columns[2:]))
    by_date = F.map_from_entries(F.collect_list(entry)).alias("by_date")
    joined = days.join(counted.groupBy("account_id").agg(by_date), "account_id", "left")
    aligned = F.transform(_valid_dates(asofs), lambda date: F.col("by_date")[date])
    return joined.withColumn("breadths", aligned).drop("by_date")


def _breadth_columns(days: DataFrame) -> dict[str, Column]:
    """The breadths of the date at place ``at``; a facet without its column counts orders."""
    none = F.lit(0).cast("bigint")
    kept = days.schema["breadths"].dataType.elementType.names if "breadths" in days.columns else []
    names = [(f"{facet}_breadth_{w}d", f"orders_{w}d") for facet in _FACETS.values() for w in WINDOWS]
    here = F.get(F.col("breadths"), F.col("at"))
    return {name: F.coalesce(here[name], none) if name in kept else F.col(orders) for name, orders in names}


def churn_window_features(invoices: DataFrame, asofs: AsOf) -> DataFrame:
    """Orders, revenue, units, products and distributors per account, date and window.

    Sums are taken from the days that ``_account_days`` lists, so an invoice is not repeated
    for the dates it counts for.
    """
    days = _with_breadths(_account_days(invoices, asofs=asofs), invoices, asofs)
    day, longest = F.col("invoice_date"), max(WINDOWS)
    end = F.least("next", F.date_add(day, longest))
    dates = F.posexplode(_dates_from(_sorted_dates(asofs), day, end)).alias("at", "asof_date")
    rows = _with_inside(days.select("*", dates)).withColumns(_window_sums(_kinds(days)))
    return rows.withColumns(_breadth_columns(days)).select(
        "account_id", "asof_date", *(f for f in FEATURES if f.endswith("0d") and "median" not in f)
    )


def _kinds(days: DataFrame) -> dict:
    element = days.schema["recent_days"].dataType.elementType
    return {f.name: f.dataType for f in element}


def _account_days(
    invoices: DataFrame, measures: Sequence[str] = MEASURES, asofs: AsOf = ()
) -> DataFrame:
    """Invoices per account and day, with the neighbouring days and those of the longest window.

    Counting per day first bounds the window of an account by the number of days,
    however many invoices it has. ``recent_days`` holds a window's length of days at most,
    each with its sums of ``measures``. With ``asofs`` only days that stand for one of these
    are listed, and the last one of each account; ``recent_days`` then leaves out those in no
    window of theirs.
    """
    along = Window.partitionBy("account_id").orderBy("day_number")
    day = F.struct(F.col("invoice_date").alias("day"), "n", *measures)
    dated = F.struct("invoice_date", "n")

    def with_gap(d: Column, place: Column) -> Column:
        before = F.get(F.col("recent_days"), place - 1)["day"]
        return F.struct(
            d["day"].alias("day"), d["n"].alias("n"), F.datediff(d["day"], before).alias("gap"),
            *(d[c].alias(c) for c in measures),
        )

    neighbours = {
        "previous": F.lag("invoice_date").over(along),
        "next": F.lead("invoice_date").over(along),
        **{f"back_{k}": F.lag(dated, k).over(along) for k in range(1, RECENT_INVOICES)},
    }
    recent = F.collect_list(day).over(along.rangeBetween(1 - max(WINDOWS), 0))
    days = (
        _dealt(invoices)
        .groupBy("account_id", "invoice_date")
        .agg(F.count(F.lit(1)).alias("n"), *(F.sum(c).alias(c) for c in measures))
        .withColumn("day_number", F.datediff("invoice_date", as_date("1970-01-01")))
    )
    if asofs:
        listed, date = _sorted_dates(asofs), F.col("invoice_date")
        before = _count_before(listed, date)
        kept = F.col("next").isNull() | (before < _count_before(listed, F.col("next")))
        seen = before < _count_before(listed, F.date_add(date, max(WINDOWS)))
        days = days.withColumns(neighbours).where(seen | kept).withColumn("recent_days", recent).where(kept)
    else:
        days = days.withColumns({**neighbours, "recent_days": recent})
    back = [F.col(f"back_{k}") for k in reversed(range(1, RECENT_INVOICES))]
    return days.withColumns(
        {"last_days": F.array_compact(F.array(*back, dated)), "recent_days": F.transform("recent_days", with_gap)}
    ).drop("day_number", *measures, *(c for c in neighbours if c.startswith("back_")))


def _recent_gaps(last_days: Column) -> Column:
    """Sorted gaps between the last few invoices: walk back day by day, 0 within a day."""
    none = F.array().cast("array<int>")
    most = RECENT_INVOICES - 1

    def back(k: int) -> Column:
        return F.get(last_days, F.size(last_days) - 1 - k)

    parts = []
    for k in range(most):
        day, before = back(k)["invoice_date"], back(k + 1)["invoice_date"]
        repeats = F.least(F.coalesce(back(k)["n"], F.lit(1)) - 1, F.lit(most))
        parts.append(F.array_repeat(F.lit(0), repeats.cast("int")))
        parts.append(
            F.when(before.isNotNull(), F.array(F.datediff(day, before))).otherwise(none)
        )
    return F.sort_array(F.slice(F.concat(*parts), 1, most))


def _middle(gaps: Column) -> Column:
    """Median of a sorted array; 0 if it is empty."""
    n = F.size(gaps)
    low = F.get(gaps, F.floor((n - 1) / 2).cast("int"))
    high = F.get(gaps, F.floor(n / 2).cast("int"))
    return F.when(n > 0, (low + high) / F.lit(2.0)).otherwise(F.lit(0.0))


def account_history(
    invoices: DataFrame,
    measures: Sequence[str] = MEASURES,
    breadths_at: AsOf = (),
    asofs: AsOf = (),
    intervals: bool = True,
) -> DataFrame:
    """Account days with the median gap of the last few invoices, written out (runs a job).

    Everything below comes from this table, so accounts are put in order once. With dates in
    ``breadths_at`` the days hold the breadths at those they stand for. With ``asofs`` only
    what these need is written; the median is left out without ``intervals``.
    """
    days = _account_days(invoices, measures, asofs)
    if intervals:
        days = days.withColumn("recent_interval", _middle(_recent_gaps(F.col("last_days"))))
    days = days.drop("last_days")
    return stage(_with_breadths(days, invoices, breadths_at) if breadths_at else days)


def _valid_dates(asofs: AsOf) -> Column:
    """An invoice day stands for every as-of date up to the account's next invoice day."""
    return _dates_from(_sorted_dates(asofs), F.col("invoice_date"), F.col("next"))


def _median_gap(inside: Column, orders: Column) -> tuple[Column, Column]:
    """Median of the gaps between the ``orders`` of the days ``inside``, 0 without any; their number.

    Gaps count if both ends are inside; further invoices on a day are gaps of 0.
    """
    days = F.size(inside)
    across = F.sort_array(F.filter(inside["gap"], lambda gap, place: place > 0))
    zeros = orders - days
    gaps = zeros + days - 1

    def at(place: Column) -> Column:
        later = F.get(across, (F.floor(place) - zeros).cast("int"))
        return F.when(F.floor(place) < zeros, F.lit(0)).otherwise(later)

    middle = (at((gaps - 1) / 2) + at(gaps / 2)) / F.lit(2.0)
    return F.when(gaps > 0, middle).otherwise(F.lit(0.0)), F.greatest(gaps, F.lit(0).cast("bigint"))


def _asof_state(history: DataFrame, asofs: AsOf, listed: AsOf = ()) -> DataFrame:
    """One row per account and as-of date from its first invoice on, with its sums and gaps.

    A day serves the dates it is the last invoice day of, so each row comes from a single one.
    ``listed`` are the dates that the history was made for, if these are more.
    """
    dates = F.posexplode(_valid_dates(listed or asofs)).alias("at", "asof_date")
    dated = history.select("*", dates)
    if listed:
        dated = dated.where(F.col("asof_date").isin(_sorted_dates(asofs)))
    state = _with_inside(dated).withColumns(_window_sums(_kinds(history)))
    found = {}
    for days in GAP_WINDOWS:
        median, gaps = _median_gap(F.col(f"inside_{days}"), F.col(f"orders_{days}d"))
        found |= {f"gap_{days}d": median, f"gaps_{days}d": gaps}
    return state.withColumns(
        {**found, "last_invoice": F.col("invoice_date"), "next_invoice": F.col("next")}
    )


def _dates_with_gaps(history: DataFrame, asofs: AsOf) -> list[dt.date]:
    """The as-of dates at which any account has a gap (runs a job).

    Gaps are first reduced to the latest end per first date, so at most as many rows as dates
    reach the driver.
    """
    days, longest = _sorted_dates(asofs), max(GAP_WINDOWS)
    day = F.col("invoice_date")
    since = F.when(F.col("n") > 1, day).otherwise(F.col("previous"))
    spans = (
        history.where(since.isNotNull())
        .groupBy(_count_before(days, day).alias("first"))
        .agg(F.max(_count_before(days, F.date_add(since, longest))).alias("end"))
    )
    return sorted({d for row in spans.collect() for d in days[row.first : row.end]})


def _with_intervals(history: DataFrame, asofs: AsOf, strict_index: bool, listed: AsOf = ()) -> DataFrame:
    state = _asof_state(history, asofs, listed)
    recent = F.col("recent_interval") if "recent_interval" in history.columns else F.lit(None)
    dated = _dates_with_gaps(history, asofs) if strict_index else []
    if dated:
        any_gap = F.col("asof_date").isin(dated)
        recent = F.when(any_gap & (F.col("gaps_180d") == 0), F.lit(0.0)).otherwise(recent)
    return state.withColumns(
        {
            "median_interval_180d": F.col("gap_180d"),
            "median_interval_recent5": recent,
            "median_interval_90d": F.col("gap_90d"),
        }
    )


def reorder_intervals(
    invoices: DataFrame, asofs: AsOf, strict_index: bool = True
) -> DataFrame:
    """Median days between invoices: last 180 and 90 days, and the last five invoices.

    ``strict_index`` keeps a property of the published features: once any account has a
    gap within 180 days of a date, the five-invoice median of accounts without one is 0.
    """
    return _with_intervals(account_history(invoices, (), asofs=asofs), asofs, strict_index).select(
        "account_id", "asof_date", "median_interval_180d", "median_interval_recent5", "median_interval_90d"
    )


def _label(horizon: int) -> Column:
    within = F.col("next_invoice") <= F.date_add("asof_date", horizon)
    return F.coalesce(within, F.lit(False)).cast("int")


def _label_complete(history: DataFrame, horizon: int) -> Column:
    """Whether the data reaches to the end of the horizon."""
    latest = history.agg(F.max("invoice_date")).scalar()
    return F.date_add("asof_date", horizon) <= latest


def churn_labels(invoices: DataFrame, asofs: AsOf, horizon: int = HORIZON_DAYS) -> DataFrame:
    """Whether each account buys again within ``horizon`` days after the date."""
    history = stage(_account_days(invoices, (), asofs).select("account_id", "invoice_date", "next"))
    return (
        history.select(
            "account_id",
            F.explode(_valid_dates(asofs)).alias("asof_date"),
            F.col("next").alias("next_invoice"),
        )
        .withColumn("label", _label(horizon))
        .withColumn("label_complete", _label_complete(history, horizon))
        .drop("next_invoice")
    )


def invoice_columns(features: Sequence[str] = ()) -> list[str]:
    """The columns of invoices from which ``features`` and labels come."""
    measures = [m for m in MEASURES if any(f.startswith(f"{m}_") for f in features)]
    facets = [c for c, facet in _FACETS.items() if any(f.startswith(f"{facet}_breadth_") for f in features)]
    return ["account_id", "invoice_date", *measures, *facets]


@dataclass(frozen=True)
class History:
    """Account days for some dates, written out once for several tables of some of these dates."""

    days: DataFrame
    asofs: tuple[dt.date, ...]
    features: tuple[str, ...]


def shared_history(invoices: DataFrame, asofs: AsOf, features: Sequence[str] = FEATURES) -> History:
    """What ``churn_features`` and ``churn_dataset`` take as ``history`` (runs a job)."""
    return History(_history_for(invoices, asofs, features), tuple(_sorted_dates(asofs)), tuple(features))


def _days_of(
    invoices: DataFrame, asofs: AsOf, features: Sequence[str], history: History | None
) -> tuple[DataFrame, AsOf]:
    """Account days and the dates they were made for, if these are more than ``asofs``."""
    if history is None:
        return _history_for(invoices, asofs, features), ()
    if not set(_sorted_dates(asofs)) <= set(history.asofs) or not set(features) <= set(history.features):
        raise ValueError("the history lacks some of the dates or features")
    return history.days, history.asofs


def _history_for(invoices: DataFrame, asofs: AsOf, features: Sequence[str]) -> DataFrame:
    wanted = [m for m in MEASURES if m in invoice_columns(features)]
    breadths = any("_breadth_" in f for f in features)
    intervals = any(f in _BY_INTERVAL for f in features)
    listed = _sorted_dates(asofs)
    return account_history(invoices, wanted, listed if breadths else (), listed, intervals)


def _all_features(
    history: DataFrame, asofs: AsOf, strict_index: bool, features: Sequence[str], listed: AsOf = ()
) -> DataFrame:
    by_interval = any(f in _BY_INTERVAL for f in features)
    joined = _with_intervals(history, asofs, strict_index and by_interval, listed)
    if any("_breadth_" in f for f in features):
        joined = joined.withColumns(_breadth_columns(history))
    angle = F.month("last_invoice") / F.lit(12.0) * F.lit(2 * math.pi)
    windowed = [f for f in FEATURES if f[-1] == "d" and f.split("_")[-1][:-1].isdigit()]
    numbers = joined.withColumns(
        {
            "days_since_last": F.datediff("asof_date", "last_invoice").cast("double"),
            **{
                f: F.coalesce(F.col(f).cast("double"), F.lit(0.0))
                for f in windowed
                if f in joined.columns and not f.startswith("median")
            },
            "sin_month": F.sin(angle),
            "cos_month": F.cos(angle),
        }
    )
    since, recent, usual = (
        F.col(c) for c in ("days_since_last", "median_interval_recent5", "median_interval_180d")
    )
    cycle = (
        F.when(recent > 0, since / recent).when(usual > 0, since / usual).otherwise(F.lit(0.0))
    )
    trend = F.when((recent > 0) & (usual > 0), usual / recent).otherwise(F.lit(1.0))
    flagged = numbers.withColumns({"days_into_cycle": cycle, "velocity_trend": trend}).withColumns(
        {
            "overdue_severity": F.col("days_into_cycle") * F.col("days_into_cycle"),
            "is_severely_overdue": (F.col("days_into_cycle") > OVERDUE_CYCLES).cast("double"),
            "is_high_frequency": (F.col("orders_90d") >= HIGH_FREQUENCY_ORDERS).cast("double"),
            "is_one_time_buyer": (F.col("orders_180d") == 1).cast("double"),
        }
    )
    # the sentinel comes after the flags, which therefore never see it
    once = F.col("is_one_time_buyer") == 1
    return flagged.withColumns(
        {
            "high_freq_overdue": F.col("is_high_frequency") * F.col("is_severely_overdue"),
            "days_into_cycle": F.when(once, NO_HISTORY).otherwise(F.col("days_into_cycle")),
            "overdue_severity": F.when(once, NO_HISTORY).otherwise(F.col("overdue_severity")),
        }
    )


def churn_features(
    invoices: DataFrame,
    asofs: AsOf,
    strict_index: bool = True,
    features: Sequence[str] = FEATURES,
    history: History | None = None,
) -> DataFrame:
    """Features per account and as-of date, each a DOUBLE without NULLs.

    Only what ``features`` need is summed up, written and joined; the rows are the same. With
    ``history``, of the same invoices, they are not read again.
    """
    days, listed = _days_of(invoices, asofs, features, history)
    return _all_features(days, asofs, strict_index, features, listed).select(
        "account_id", "asof_date", *features
    )


def churn_dataset(
    invoices: DataFrame,
    asofs: AsOf,
    horizon: int = HORIZON_DAYS,
    strict_index: bool = True,
    features: Sequence[str] = FEATURES,
    history: History | None = None,
) -> DataFrame:
    """Features, see ``churn_features``, and labels from one pass over the account days."""
    days, listed = _days_of(invoices, asofs, features, history)
    return _all_features(days, asofs, strict_index, features, listed).select(
        "account_id",
        "asof_date",
        *features,
        _label(horizon).alias("label"),
        _label_complete(days, horizon).alias("label_complete"),
    )
