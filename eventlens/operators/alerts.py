"""Alert operators: the business logic of the reference's stateful functions,
as per-key ordered scans (see ``ordered_scan``).

* ALR1 running-mean deviation (``TempWarning``)
* ALR2 in-window running mean, high only (``AvgTempFunction.add``)
* ALR3 / ALR4 two-in-a-row breach, keep and drop variants (``QaWarning``)
* AGG6 keyed running sum (``keyBy(...).sum``)

Every operator takes the key, the event-time column and a tie-break
(``order``) so the scan order is total; the reference follows arrival order,
which equals this order for in-order input.

Each operator has a ``..._step`` form that takes the state after earlier
rows (or None) and also returns the state after these, for streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import messages
from .ordered_scan import _cols, gt, scan_with_state

DEFAULT_MARGIN = 5
DEFAULT_RATE = 0.1
WINDOW_MARGIN = 5.0
METRICS = ("acid", "cons", "water_rate")


def _ordering(ts: str, order, arrival: bool) -> list[str]:
    """Scan order: event time then the tie-break (canonical), or the
    tie-break alone (``arrival=True``: the order lines were read in, which
    is what the reference's keyed functions see)."""
    return _cols(order) if arrival else [ts, *_cols(order)]


SUM_TYPE = "decimal(28,10)"
SUM_LIMIT = 1e17


def _summable(df: DataFrame, value: str) -> DataFrame:
    """Splits readings for running sums that do not depend on how rows are
    grouped: ``_xv`` holds the reading in DECIMAL, whose sums are exact, and
    ``_bv`` what that leaves, in double: nothing for readings of up to ten
    decimals, all of it for NaN, infinities and magnitudes over
    :data:`SUM_LIMIT`, which then behave as in a double sum."""
    v = F.col(value).cast("double")
    fits = F.coalesce(~F.isnan(v) & (F.abs(v) < SUM_LIMIT), F.lit(False))
    exact = F.when(fits, v).otherwise(F.lit(0.0)).cast(SUM_TYPE)
    return (df.withColumn("_xv", exact)
            .withColumn("_bv", F.when(v.isNull(), F.lit(0.0)).otherwise(v - exact.cast("double"))))


def _sum_before() -> Column:
    return F.col("_sb__xv").cast("double") + F.col("_sb__bv")


def running_mean_alerts(df: DataFrame, *args, **options) -> DataFrame:
    """ALR1 over all of ``df``: see :func:`running_mean_step`."""
    return running_mean_step(df, None, *args, **options)[0]


def running_mean_step(df: DataFrame, state: DataFrame | None, key: str = "id", ts: str = "ts", value: str = "temp",
                      order=("seq",), margin: float = DEFAULT_MARGIN, time_col: str = "time",
                      arrival: bool = False, slice_width: str | int | None = None) -> tuple[DataFrame, DataFrame]:
    """ALR1: ``high`` when ``value > mean + margin``, ``low`` when
    ``value < mean - margin`` (strict), where ``mean`` is over the key's
    earlier readings; every reading then joins the mean.  The first reading
    of a key has no mean and never alerts; NaN compares false, and a NaN or
    infinite reading stays in all later means of its key.

    The rule is the reference's (sum and count, compared in double) with the
    sum kept exactly (:func:`_summable`), so that the result does not depend
    on the plan."""
    s, after = scan_with_state(_summable(df, value), key, _ordering(ts, order, arrival), sums=["_xv", "_bv"],
                               maxes=[ts], row_number=True, slice_width=slice_width, state=state)
    n_before = F.col("_rn") - 1
    mean = F.when(n_before > 0, _sum_before() / n_before)
    kinds = F.array_compact(F.array(F.when(gt(F.col(value), mean + F.lit(margin)), F.lit("high")),
                                    F.when(gt(mean - F.lit(margin), F.col(value)), F.lit("low"))))
    out = (s.select(F.col(key), F.col(ts), F.col(time_col), F.col(value), n_before.alias("n_before"),
                    _sum_before().alias("sum_before"), F.explode(kinds).alias("kind")))
    return out.withColumn("message", messages.temp_alert(key, time_col, value, "kind")), after


def window_mean_alerts(df: DataFrame, *args, **options) -> DataFrame:
    """ALR2 over all of ``df``: see :func:`window_mean_step`."""
    return window_mean_step(df, None, *args, **options)[0]


def window_mean_step(df: DataFrame, state: DataFrame | None, key: str = "id", ts: str = "ts", value: str = "temp",
                     order=("seq",), size: str = "1 day", margin: float = WINDOW_MARGIN, time_col: str = "time",
                     arrival: bool = False, slice_width: str | int | None = None) -> tuple[DataFrame, DataFrame]:
    """ALR2: inside each tumbling window of the key, alert when
    ``value - mean_so_far > margin``; the mean restarts with every window.
    Sums as in :func:`running_mean_step`."""
    win = F.window(ts, size).start.alias("window_start")
    keyed = _summable(df, value).withColumn("window_start", win)
    s, after = scan_with_state(keyed, [key, "window_start"], _ordering(ts, order, arrival), sums=["_xv", "_bv"],
                               row_number=True, slice_width=slice_width, state=state)
    n_before = F.col("_rn") - 1
    mean = F.when(n_before > 0, _sum_before() / n_before)
    hit = gt(F.col(value) - mean, F.lit(margin))
    return (s.filter(hit)
            .select(F.col(key), "window_start", F.col(ts), F.col(time_col), F.col(value),
                    n_before.alias("n_before"), _sum_before().alias("sum_before"),
                    F.lit("high").alias("kind"))
            .withColumn("message", messages.temp_alert(key, time_col, value, "kind"))), after


def breach_alerts(df: DataFrame, *args, **options) -> DataFrame:
    """ALR3 / ALR4 over all of ``df``: see :func:`breach_step`."""
    return breach_step(df, None, *args, **options)[0]


def breach_step(df: DataFrame, state: DataFrame | None, key: str = "id", ts: str = "ts", order=(), metrics=METRICS,
                rate: float = DEFAULT_RATE, variant: str = "keep", time_col: str = "time",
                with_message: bool = False, arrival: bool = False,
                slice_width: str | int | None = None, hot_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """ALR3 (``keep``) / ALR4 (``drop``): alert for metric ``m`` when two
    readings in a row exceed the baseline reading by more than ``rate``.

    State machine of the reference (at most two stored readings): with one
    stored reading ``s0`` a breach (any metric ``v.m > s0.m * (1 + rate)``)
    stores ``v`` as the second; no breach keeps ``[v]`` (keep) or empties the
    state (drop).  With ``[s0, s1]`` stored, each metric alerts when both
    ``s1.m`` and ``v.m`` exceed ``s0.m * (1 + rate)``; then the state is
    ``[v]``.

    Closed form: the stored readings are always the previous one or two
    rows, so only the state's size depends on history.  Row ``i`` meets a
    two-reading state iff

    * keep: the run of consecutive breaches ending at row ``i-1`` has odd
      length (position of the last earlier non-breaching row: the scan's
      ``mark``, computed in the same pass);
    * drop: ``i`` is odd, ``i >= 3`` (sizes alternate strictly).
    """
    if variant not in ("keep", "drop"):
        raise ValueError("variant is 'keep' or 'drop'")
    metrics = list(metrics)
    ordering = _ordering(ts, order, arrival)
    factor = F.lit(1.0 + rate)
    if time_col not in df.columns:
        df = df.withColumn(time_col, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))

    def non_breach(cur, prev):
        # row i does not breach row i-1 on any metric; row 1 (no previous
        # row) counts as non-breaching
        b = F.lit(False)
        for m in metrics:
            b = b | F.coalesce(gt(cur(m), prev(m) * factor), F.lit(False))
        return ~b

    s, after = scan_with_state(df, key, ordering, lags=[*metrics, time_col], maxes=[ts], row_number=True,
                               mark=non_breach if variant == "keep" else None, slice_width=slice_width, hot_rows=hot_rows,
                               state=state)
    rn = F.col("_rn")
    over = {m: (gt(F.col(m), F.col(f"_l2_{m}") * factor),                    # v over s0
                gt(F.col(f"_l1_{m}"), F.col(f"_l2_{m}") * factor))           # s1 over s0
            for m in metrics}
    if variant == "drop":
        two = (rn >= 3) & (rn % 2 == 1)
    else:
        run = (rn - 1) - F.col("_mk")              # breaches in a row ending at row i-1
        two = (rn >= 3) & (run % 2 == 1)
    fired = F.array_compact(
        F.array(*[F.when(two & over[m][0] & over[m][1],
                         F.struct(F.lit(m).alias("metric"),
                                  F.col(f"_l1_{time_col}").alias("first_time"),
                                  F.col(f"_l1_{m}").cast("double").alias("first_value"),
                                  F.col(time_col).alias("second_time"),
                                  F.col(m).cast("double").alias("second_value")))
                  for m in metrics]))
    out = s.select(F.col(key), F.col(ts), *[F.col(c) for c in _cols(order)],
                   F.explode(fired).alias("a")).select(
        key, ts, *_cols(order), "a.metric", "a.first_time", "a.first_value", "a.second_time", "a.second_value")
    if with_message:
        out = out.withColumn("message", messages.breach_alert(key, "metric", "first_time", "first_value",
                                                              "second_time", "second_value"))
    return out, after


def keyed_running_sum(df: DataFrame, key_expr: Column, value: str, ts: str, **options) -> DataFrame:
    """AGG6 over all of ``df``: see :func:`running_sum_step`."""
    return running_sum_step(df, None, key_expr, value, ts, **options)[0]


def running_sum_step(df: DataFrame, state: DataFrame | None, key_expr: Column, value: str, ts: str, order=("seq",),
                     key_name: str = "key", arrival: bool = False,
                     slice_width: str | int | None = None) -> tuple[DataFrame, DataFrame]:
    """AGG6: ``keyBy(f).sum(field)``: for every element, the running sum of
    ``value`` of its key (the key may be any expression, e.g. a boolean)."""
    keyed = _summable(df.withColumn(key_name, key_expr), value)
    s, after = scan_with_state(keyed, key_name, _ordering(ts, order, arrival), sums=["_xv", "_bv"],
                               maxes=[ts], slice_width=slice_width, state=state)
    total = (F.col("_sb__xv") + F.col("_xv")).cast("double") + (F.col("_sb__bv") + F.col("_bv"))
    return s.withColumn(f"running_{value}", total).drop("_sb__xv", "_sb__bv", "_xv", "_bv", f"_mb_{ts}"), after
