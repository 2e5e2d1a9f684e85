"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DateType


# Row bounds under which a dimension is broadcast. Above them the join is
# left to the planner (sort-merge join, or AQE's own size-checked broadcast).
CALENDAR_MAX_ROWS = 1_000_000      # ~2,700 years of days
CODE_TABLE_MAX_ROWS = 1_000_000    # demographic / income code tables


def checked_rows(df: DataFrame, bound: int) -> int:
    """Rows of ``df`` up to ``bound + 1`` (a bounded job: the scan stops at
    the limit), remembered on the DataFrame object so it runs once."""
    memo = getattr(df, "_retail_mart_rows", None)
    if memo is None:
        memo = {}
        try:
            df._retail_mart_rows = memo
        except AttributeError:
            pass
    if bound not in memo:
        memo[bound] = df.limit(bound + 1).count()
    return memo[bound]


def small_side(df: DataFrame, max_rows: int, base: DataFrame | None = None) -> DataFrame:
    """``df`` marked for broadcast if ``base`` (default ``df``) has at most
    ``max_rows`` rows; otherwise unmarked, so the planner picks a shuffled
    join. The broadcast never grows past the checked bound."""
    if checked_rows(base if base is not None else df, max_rows) <= max_rows:
        return F.broadcast(df)
    return df


def calendar(date_dim: DataFrame, *cols, where=None) -> DataFrame:
    """The calendar (optionally filtered / projected), broadcast when its
    size is within CALENDAR_MAX_ROWS -- it holds 366 rows per year of span,
    independent of the fact volume."""
    out = date_dim if where is None else date_dim.filter(where)
    out = out.select(*cols) if cols else out
    return small_side(out, CALENDAR_MAX_ROWS, base=date_dim)


def check_calendar(date_dim: DataFrame) -> None:
    """Raise unless every day is in the calendar once and a (week, year) has
    at most one day 0; one row to the driver, once per DataFrame."""
    if getattr(date_dim, "_retail_mart_calendar", False):
        return
    zero = F.when(F.col("day_of_wk_num") == 0, F.struct("wk_num", "yr_num"))
    days, distinct, starts, weeks = date_dim.agg(F.count("d_date_sk"), F.countDistinct("d_date_sk"),
                                                 F.count(zero), F.countDistinct(zero)).first()
    if days != distinct or starts != weeks:
        raise ValueError(f"calendar: {days - distinct} repeated days, {starts - weeks} weeks with a second day 0")
    date_dim._retail_mart_calendar = True


def for_report(df: DataFrame) -> DataFrame:
    """Result-set types: exact decimals leave as double, dates as timestamp."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DecimalType):
            out.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, DateType):
            out.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


NULL_SPREAD = 1 << 16


def left_join_spread_nulls(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                           spread: int = NULL_SPREAD) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key``, with NULL keys salted.

    A NULL key never matches, but hash partitioning would send every NULL-key
    row (possibly a third of the table) to one reducer. The join runs on one
    composite key: (is-NULL flag, key) on the right is (false, key); a
    left row with a NULL key gets (true, salt), the salt a deterministic hash
    of the row in 1..spread (stable under task retries). Those rows spread
    over all reducers and still match nothing. One join, no duplicated
    upstream work, nothing replicated. Keys are integer surrogate keys.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(spread)) + 1
    lk = F.struct(F.col(left_key).isNull().alias("n"),
                  F.coalesce(F.col(left_key).cast("long"), salt).alias("k"))
    rk = F.struct(F.lit(False).alias("n"), F.col(right_key).cast("long").alias("k"))
    l2 = left.withColumn("__jk", lk)
    r2 = right.withColumn("__rjk", rk)
    return l2.join(r2, l2["__jk"] == r2["__rjk"], "left").drop("__jk", "__rjk")
