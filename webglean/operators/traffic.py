"""Rate and concurrency of request logs."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .scan import ordered_blocks, split_hot

# Fixed value: the default bound on calls in flight.
DEFAULT_CONCURRENCY = 10

# Rows of one key that a single task may scan; a smaller number holds up to ``scan.BLOCK_ROWS``.
HOT_ROWS = 5_000_000


def _micros(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970, for timestamps with and without a zone."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(column))
    return F.unix_micros(F.col(column))


def rate_schedule(
    requests: DataFrame, key: str, ts: str, seq: str, rate: float, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``wait_us`` and ``granted_at``: the earliest time a token bucket lets each request pass.

    The bucket of each ``key`` starts full and holds ``rate`` tokens; it gains ``rate`` per second.
    Requests go in order of ``ts``, ties by ``seq``. A rate of 0 or less means no limit. A rate
    between 0 and 1 could never grant anything, because the bucket holds no whole token.

    With requests numbered from 1, c = 1/rate and M(i) = max(t(j) - j*c) over j <= i, the grant is
    max(t(i), M(i-1) + (i - (rate - 1)) * c): a running maximum, no simulation. With the rate as a
    fraction p/q all terms times p are whole numbers, so no order of adding changes a result; the
    wait is rounded once, halves up.
    """
    if 0 < rate < 1:
        raise ValueError("a rate between 0 and 1 never grants a request")
    if rate <= 0:
        return requests.withColumns({"wait_us": F.lit(0).cast("long"), "granted_at": F.col(ts)})
    exact = Fraction(str(rate))
    cost = _whole(F.lit(1_000_000 * exact.denominator))
    columns = requests.columns
    timed = requests.withColumn("_t", _whole(_micros(requests, ts)) * _whole(F.lit(exact.numerator)))
    split = split_hot(timed, [key], hot_rows)

    done = _grants(_numbered(split.cold, [key], seq, cost), F.col("_i"), F.col("_before"), exact, cost)
    if split.hot is not None:
        done = done.unionByName(_hot_grants(split.hot, key, seq, exact, cost, split.blocks))
    return done.select(
        *columns,
        "wait_us",
        F.timestamp_add("MICROSECOND", F.col("wait_us"), F.col(ts)).alias("granted_at"),
    )


def _whole(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def _times(i: Column, cost: Column) -> Column:
    return _whole(_whole(i) * cost)


def _numbered(df: DataFrame, keys: list[str], seq: str, cost: Column) -> DataFrame:
    """Add ``_i``, ``_m`` = t - i*cost, and ``_before``, the maximum of ``_m`` over earlier rows."""
    in_order = Window.partitionBy(*keys).orderBy("_t", seq)
    numbered = df.withColumn("_i", F.row_number().over(in_order)).withColumn(
        "_m", _whole(F.col("_t") - _times(F.col("_i"), cost))
    )
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    return numbered.withColumn("_before", F.max("_m").over(earlier))


def _grants(df: DataFrame, i: Column, before: Column, rate: Fraction, cost: Column) -> DataFrame:
    p = rate.numerator
    full = _whole(F.lit((p - rate.denominator) * 1_000_000))  # (rate - 1) * c, times p
    late = _whole(_whole(before + _times(i, cost)) - full - F.col("_t"))
    late = F.greatest(_whole(F.lit(0)), F.coalesce(late, _whole(F.lit(0))))
    df = df.withColumn("_late", _whole(2 * late + _whole(F.lit(p))))
    wait = F.expr(f"_late div cast({2 * p} as decimal(38,0))")
    return df.withColumn("wait_us", wait.cast("long")).drop("_i", "_m", "_before", "_t", "_late")


def _hot_grants(
    hot: DataFrame, key: str, seq: str, rate: Fraction, cost: Column, blocks: int
) -> DataFrame:
    blocked = ordered_blocks(hot, [key], ["_t", seq], blocks)
    local = _numbered(blocked, [key, "_block"], seq, cost)
    totals = local.groupBy(key, "_block").agg(
        F.count(F.lit(1)).alias("_rows"), F.max("_m").alias("_top")
    )
    # One row per key and block: as many as there are blocks and hot keys.
    along = Window.partitionBy(key).orderBy("_block")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    carried = carried.withColumn(
        "_carry", F.max(_whole(F.col("_top") - _times(F.col("_offset"), cost))).over(earlier)
    ).select(F.col(key).alias("_key"), F.col("_block").alias("_at"), "_offset", "_carry")
    joined = local.join(
        F.broadcast(carried),
        local[key].eqNullSafe(F.col("_key")) & (local["_block"] == F.col("_at")),
    )
    before = F.greatest("_carry", _whole(F.col("_before") - _times(F.col("_offset"), cost)))
    granted = _grants(joined, F.col("_offset") + F.col("_i"), before, rate, cost)
    return granted.drop("_block", "_key", "_at", "_offset", "_carry")


def peak_in_flight(
    requests: DataFrame, key: str, start: str, end: str,
    cap: int = DEFAULT_CONCURRENCY, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``(key, peak, within_cap)``: the most intervals open at once. An interval ends before another
    starts at the same time. Starts and ends are added up per moment before anything is shuffled.
    A null end is still open; a row without a start was never in flight and doesn't count.
    """
    moments = requests.filter(F.col(start).isNotNull()).select(
        key,
        F.inline(
            F.array(
                F.struct(F.col(start).alias("_t"), F.lit(1).alias("_step")),
                F.struct(F.col(end).alias("_t"), F.lit(-1).alias("_step")),
            )
        ),
    ).filter(F.col("_t").isNotNull())
    if cap < 1:
        raise ValueError("concurrency must be >= 1")
    split = split_hot(moments, [key], hot_rows)
    steps = split.cold.groupBy(key, "_t").agg(F.sum("_step").alias("_step"))
    so_far = Window.partitionBy(key).orderBy("_t").rowsBetween(Window.unboundedPreceding, 0)
    peaks = steps.withColumn("_open", F.sum("_step").over(so_far)).groupBy(key).agg(
        F.max("_open").alias("peak")
    )
    if split.hot is not None:
        peaks = peaks.unionByName(_hot_peaks(split.hot, key, split.blocks))
    peak = F.greatest(F.col("peak"), F.lit(0))
    return peaks.select(key, peak.alias("peak"), (peak <= cap).alias("within_cap"))


def _hot_peaks(hot: DataFrame, key: str, blocks: int) -> DataFrame:
    steps = hot.groupBy(key, "_t").agg(F.sum("_step").alias("_step"))
    blocked = ordered_blocks(steps, [key], ["_t"], blocks)
    so_far = Window.partitionBy(key, "_block").orderBy("_t").rowsBetween(
        Window.unboundedPreceding, 0
    )
    totals = blocked.withColumn("_open", F.sum("_step").over(so_far)).groupBy(key, "_block").agg(
        F.max("_open").alias("_top"), F.sum("_step").alias("_sum")
    )
    earlier = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_sum").over(earlier), F.lit(0))
    return totals.withColumn("_peak", F.col("_top") + offset).groupBy(key).agg(
        F.max("_peak").alias("peak")
    )
