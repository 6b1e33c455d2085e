"""Per-key ordered scans that stay parallel when one key holds most rows.

The reference's keyed process functions walk each key's readings in order
and keep running state (a count and sum, the last two readings).  The
direct Spark form is a window ``PARTITION BY key ORDER BY ts``, which sends
every row of a key to one task: a sensor holding a third of the data would
be a third of the job in one task.

``scan`` is a two-level prefix instead:

1. a row's *slice* is an expression of its first order column (a stretch of
   time, or of consecutive numbers), so it is the same in every run and
   needs neither a sample nor a checkpoint; a hot key spreads over its
   slices, and a slice's size is bounded by the key's rate, not its history;
2. one exchange on (key, slice) and a window in each slice: local row
   number, exclusive running sums / max, ``lag`` 1 and 2, and a running
   flag that depends on the previous row (``mark``);
3. each slice is summarised in place (count, totals, first and last rows,
   only the columns that lags and marks need), and a window over these
   summaries, one row per slice, gives what precedes each slice.  The
   summary refers to every column (a hash, never null), so both uses of the
   slices ask for the same exchange and Spark runs it once;
4. that carry-in is joined back on (key, slice), on which the rows are
   partitioned already; Spark decides by size whether to broadcast it.

A slice costs more than its rows where keys are many and small.  With
``hot_rows`` only keys of more rows than that are cut into slices, all others
are one: keys are counted first, in one more pass over them, and the hot ones
(at most rows / ``hot_rows``) are broadcast.

The state after a part of the data has the same form as a slice's summary,
so a stream's micro-batches go on where the last one ended
(:func:`scan_with_state`).

Nothing runs while the query is built, and the plan does not depend on the
data's size or on any setting.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import duration_seconds

SLICE_TIME = "1 hour"
SLICE_ROWS = 1 << 18
HOT_ROWS = 1 << 18


class Earlier:
    """The state before a stream's trigger: ``find`` gets the keys of the
    trigger's rows and returns their state, or None.  The summaries of the
    rows are computed once for the trigger's output and its new state; the
    caller keeps the rows (they are read for their keys too) and releases
    the summaries when both are written."""

    def __init__(self, find: Callable[[DataFrame], DataFrame | None]):
        self.find, self.kept = find, []

    def release(self) -> None:
        for df in self.kept:
            df.unpersist()


def _cols(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def slice_expr(df: DataFrame, column: str, width: str | int | None = None) -> Column:
    """The slice of a row: ``width`` of time (default :data:`SLICE_TIME`) for
    a time column, ``width`` consecutive values (default :data:`SLICE_ROWS`)
    for a whole-number column.  Choose it so that one key's rows of a slice
    fit a task."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        seconds = duration_seconds(str(width or SLICE_TIME))
        return F.floor(F.unix_micros(F.col(column).cast("timestamp")) / F.lit(seconds * 1_000_000))
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.floor(F.col(column) / F.lit(int(width or SLICE_ROWS)))
    raise ValueError(f"slices need a time or whole-number order column, {column} is {kind.simpleString()}")


def sliced(df: DataFrame, keys: list[str], column: str, width: str | int | None = None, hot_rows: int | None = None) -> DataFrame:
    """``df`` with ``_part``, the key and slice of a row: one struct column,
    so null keys compare equal in windows and joins alike."""
    key, place = F.struct(*keys), slice_expr(df, column, width)
    part = lambda s: F.struct(key.alias("key"), s.alias("slice"), F.lit(1).alias("now"))
    if not hot_rows:
        return df.withColumn("_part", part(place))
    hot = df.groupBy(key.alias("_hot")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select("_hot")
    marked = df.join(F.broadcast(hot), key == F.col("_hot"), "left")
    return marked.withColumn("_part", part(F.when(F.col("_hot").isNotNull(), place).otherwise(F.lit(0)))).drop("_hot")


def scan(df: DataFrame, keys, order, **options) -> DataFrame:
    """The rows of :func:`scan_with_state`, from the start of every key."""
    return scan_with_state(df, keys, order, **options)[0]


def scan_with_state(df: DataFrame, keys, order, *, sums=(), maxes=(), lags=(), row_number: bool = False, mark=None,
                    slice_width: str | int | None = None, hot_rows: int | None = None,
                    state: DataFrame | Earlier | None = None) -> tuple[DataFrame, DataFrame]:
    """Add exclusive per-key prefix aggregates in ``order``:

    * ``_rn``: 1-based position of the row in its key (``row_number``);
    * ``_sb_<c>``: sum of ``c`` over the key's earlier rows (0 for the first);
    * ``_mb_<c>``: max of ``c`` over the key's earlier rows (NULL for the first);
    * ``_l1_<c>``, ``_l2_<c>``: ``c`` of the previous and second previous row;
    * ``_mk`` (with ``mark``): ``_rn`` of the last earlier row for which
      ``mark(cur, prev)`` held, NULL if none.  ``mark`` gets two accessors,
      ``cur(c)`` and ``prev(c)`` (``c`` among ``lags``; ``prev`` is NULL on a
      key's first row), and returns a boolean column (NULL counts as false).

    ``order`` must make rows of a key unique (add a sequence column).  NULL
    keys are a group like any other, NULL order values come first.

    Returns the rows and the state after them: one row per key with its
    count, totals, maxima, last two rows and last mark.  Passed as ``state``
    with a later part of the data, it goes on from there: it stands for a
    slice before all others.  An :class:`Earlier` as ``state`` finds that of
    the keys of ``df`` (a ``key`` column); then only these keys' state is
    returned, and only keys of more than :data:`HOT_ROWS` rows are sliced.
    """
    keys, order = _cols(keys), _cols(order)
    sums, maxes, lags = _cols(sums), _cols(maxes), _cols(lags)
    zero = {c: F.lit(0).cast(df.schema[c].dataType) for c in sums}
    earlier = state if isinstance(state, Earlier) else None
    if earlier and hot_rows is None:
        hot_rows = HOT_ROWS
    w = Window.partitionBy("_part").orderBy(*order)
    wb = w.rowsBetween(Window.unboundedPreceding, -1)
    local = sliced(df, keys, order[0], slice_width, hot_rows).select(
        F.col("*"),
        F.row_number().over(w).cast("bigint").alias("_lrn"),
        *[F.coalesce(F.sum(c).over(wb), zero[c]).alias(f"_lsb_{c}") for c in sums],
        *[F.max(c).over(wb).alias(f"_lmb_{c}") for c in maxes],
        *[F.lag(c, k).over(w).alias(f"_ll{k}_{c}") for c in lags for k in (1, 2)],
    )
    if mark:
        # marks of rows 2.. of the slice are exact (their previous row is in
        # the slice); row 1's mark is settled with the carry-in
        m = F.coalesce(mark(F.col, lambda c: F.col(f"_ll1_{c}")), F.lit(False))
        lmp = F.when((F.col("_lrn") >= 2) & m, F.col("_lrn"))
        local = local.select(
            F.col("*"), lmp.alias("_lmp"),
            F.first(m).over(w).alias("_lm1"),          # row 1, previous row unknown
            F.max(lmp).over(wb).alias("_lmk"))         # same window spec: no new exchange

    # what a slice passes on, one row per (key, slice)
    ends = F.struct(F.lit(1).alias("_"), *[F.col(c).alias(f"v_{c}") for c in lags],
                    *[F.col(f"_ll1_{c}").alias(f"p_{c}") for c in lags])
    summ = local.groupBy("_part").agg(
        F.max("_lrn").alias("_cnt"),
        *[F.sum(c).alias(f"_tot_{c}") for c in sums],
        *[F.max(c).alias(f"_max_{c}") for c in maxes],
        F.max_by(ends, F.col("_lrn")).alias("_last"),
        F.min_by(ends, F.col("_lrn")).alias("_first"),
        *([F.max("_lmp").alias("_lmpmax")] if mark else []),
        F.max(F.hash(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()])).alias("_seen"),
    )
    if earlier:
        state = earlier.find(df.select(F.struct(*keys).alias("key")).distinct())
    if state is not None:
        before = F.struct(F.col("key"), F.lit(None).cast("bigint").alias("slice"), F.lit(0).alias("now"))
        summ = summ.unionByName(state.withColumn("_first", F.col("_last")).withColumn("_part", before)
                                .withColumn("_seen", F.lit(0)).drop("key"))
    if earlier:
        summ = summ.persist()
        earlier.kept.append(summ)
    wc = Window.partitionBy("_part.key").orderBy("_part.now", "_part.slice")
    wcb = wc.rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select(
        F.col("_part").alias("_cpart"),
        F.coalesce(F.sum("_cnt").over(wcb), F.lit(0)).alias("_cb"),
        *[F.sum(f"_tot_{c}").over(wcb).alias(f"_csb_{c}") for c in sums],
        *[F.max(f"_max_{c}").over(wcb).alias(f"_cmb_{c}") for c in maxes],
        F.lag("_last", 1).over(wc).alias("_p1"),
        F.lag("_last", 2).over(wc).alias("_p2"),
        F.lag("_cnt", 1).over(wc).alias("_pc"),
        "_first", "_last", "_cnt", "_seen", *[f"_tot_{c}" for c in sums], *[f"_max_{c}" for c in maxes],
        *(["_lmpmax"] if mark else []),
    )
    if mark:
        # first row's mark against the previous slice's last row, then the
        # last marked position of each slice, then the max over earlier slices
        mf = F.coalesce(mark(lambda c: F.col(f"_first.v_{c}"), lambda c: F.col(f"_p1.v_{c}")), F.lit(False))
        carry = carry.withColumn("_mf", mf)
        last_mark = F.greatest(F.when(F.col("_mf"), F.col("_cb") + 1), F.col("_cb") + F.col("_lmpmax"))
        wck = (Window.partitionBy("_cpart.key").orderBy("_cpart.now", "_cpart.slice")
               .rowsBetween(Window.unboundedPreceding, -1))
        carry = carry.withColumn("_cmk", F.max(last_mark).over(wck)).withColumn("_mark", last_mark)

    # the state after all slices of a key, in the form of one slice
    before_last = lambda c: F.when(F.col("_cnt") >= 2, F.col(f"_last.p_{c}")).otherwise(F.col(f"_p1.v_{c}"))
    after = F.struct(
        (F.col("_cb") + F.col("_cnt")).alias("_cnt"),
        *[(F.coalesce(F.col(f"_csb_{c}"), zero[c]) + F.coalesce(F.col(f"_tot_{c}"), zero[c])).cast(summ.schema[f"_tot_{c}"].dataType).alias(f"_tot_{c}") for c in sums],
        *[F.greatest(f"_cmb_{c}", f"_max_{c}").alias(f"_max_{c}") for c in maxes],
        F.struct(F.lit(1).alias("_"), *[F.col(f"_last.v_{c}").alias(f"v_{c}") for c in lags],
                 *[before_last(c).alias(f"p_{c}") for c in lags]).alias("_last"),
        *([F.greatest("_cmk", "_mark").alias("_lmpmax")] if mark else []))
    ended = (carry.groupBy(F.col("_cpart.key").alias("key"))
             .agg(F.max_by(after, F.struct("_cpart.now", "_cpart.slice")).alias("s")).select("key", "s.*"))

    own = ["_cpart", "_seen", "_cb", "_p1", "_p2", "_pc", *[f"_csb_{c}" for c in sums], *[f"_cmb_{c}" for c in maxes],
           *(["_mf", "_cmk"] if mark else [])]
    j = local.join(carry.select(*own), (F.col("_part") == F.col("_cpart")) & F.col("_seen").isNotNull())
    first, second = F.col("_lrn") == 1, F.col("_lrn") == 2
    cb = F.col("_cb")
    out = [F.col(c) for c in df.columns]
    if row_number or mark:
        out.append((F.col("_lrn") + cb).alias("_rn"))
    for c in sums:
        out.append((F.col(f"_lsb_{c}") + F.coalesce(F.col(f"_csb_{c}"), zero[c])).alias(f"_sb_{c}"))
    for c in maxes:
        out.append(F.greatest(F.col(f"_lmb_{c}"), F.col(f"_cmb_{c}")).alias(f"_mb_{c}"))
    for c in lags:
        prev1 = F.col(f"_p1.v_{c}")
        prev2 = F.when(F.col("_pc") >= 2, F.col(f"_p1.p_{c}")).otherwise(F.col(f"_p2.v_{c}"))
        out.append(F.when(first, prev1).otherwise(F.col(f"_ll1_{c}")).alias(f"_l1_{c}"))
        out.append(F.when(first, prev2).when(second, prev1).otherwise(F.col(f"_ll2_{c}")).alias(f"_l2_{c}"))
    if mark:
        first_marked = F.coalesce(F.col("_mf"), F.col("_lm1"))
        out.append(F.when(first, F.col("_cmk"))
                   .otherwise(F.greatest(F.col("_cmk"), F.when(first_marked, cb + 1), cb + F.col("_lmk")))
                   .alias("_mk"))
    return j.select(*out), ended


def gt(a: Column, b: Column) -> Column:
    """``a > b`` with JVM double semantics: false when either side is NaN
    (Spark orders NaN above every number)."""
    return (a > b) & ~F.isnan(a.cast("double")) & ~F.isnan(b.cast("double"))
