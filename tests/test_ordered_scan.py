"""The sliced scan equals one window per key, including hot keys split over
many slices, slices of one row and NULL keys."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventlens.operators.ordered_scan import Earlier, gt, scan, scan_with_state, sliced


def _data(spark, seed, n=600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # one key holds most rows; a few small keys and a NULL key
        k = "hot" if rng.random() < 0.7 else rng.choice(["a", "b", "c", None])
        rows.append((k, rng.randint(0, 50), i, float(rng.randint(0, 20)), rng.randint(0, 5)))
    return spark.createDataFrame(rows, "k string, t int, seq int, v double, w int")


def _mark(cur, prev):
    return ~F.coalesce(gt(cur("v"), prev("v") * 1.1), F.lit(False))


def window_scan(df, keys, order, sums=(), maxes=(), lags=(), mark=None):
    """The plain form: one window per key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    wb = w.rowsBetween(Window.unboundedPreceding, -1)
    out = [F.col("*"), F.row_number().over(w).cast("bigint").alias("_rn")]
    out += [F.coalesce(F.sum(c).over(wb), F.lit(0).cast(df.schema[c].dataType)).alias(f"_sb_{c}") for c in sums]
    out += [F.max(c).over(wb).alias(f"_mb_{c}") for c in maxes]
    for c in lags:
        out += [F.lag(c, 1).over(w).alias(f"_l1_{c}"), F.lag(c, 2).over(w).alias(f"_l2_{c}")]
    res = df.select(*out)
    m = F.coalesce(mark(F.col, lambda c: F.col(f"_l1_{c}")), F.lit(False))
    return res.withColumn("_mk", F.max(F.when(m, F.col("_rn"))).over(wb))


COLS = ["k", "seq", "_rn", "_sb_v", "_mb_w", "_l1_v", "_l2_v", "_l1_t", "_l2_t", "_mk"]
KW = dict(sums=["v"], maxes=["w"], lags=["v", "t"], mark=_mark)


def _rows(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=repr)


@pytest.mark.parametrize("seed,width", [(1, 1), (2, 3), (3, 10), (4, 1000)])
def test_sliced_equals_window(spark, seed, width):
    df = _data(spark, seed)
    a = scan(df, "k", ["t", "seq"], row_number=True, slice_width=width, **KW)
    assert _rows(a) == _rows(window_scan(df, ["k"], ["t", "seq"], **KW))
    assert set(a.columns) == {*df.columns, *COLS}  # no helper column is left


def test_one_key_with_nearly_all_rows(spark):
    df = spark.range(20_000).selectExpr("IF(id % 100 = 0, 'a', 'hot') AS k", "CAST(id AS int) AS t", "CAST(id AS int) AS seq",
                                        "CAST(id % 17 AS double) AS v", "CAST(id % 5 AS int) AS w")
    a = scan(df, "k", ["t", "seq"], row_number=True, slice_width=500, **KW)
    assert _rows(a) == _rows(window_scan(df, ["k"], ["t", "seq"], **KW))


def test_single_row_slices(spark):
    # lag 2 and marks must reach across consecutive one-row slices
    rows = [("k", i, i, float((i * 7) % 5), i % 3) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, t int, seq int, v double, w int")
    a = scan(df, "k", ["t", "seq"], row_number=True, slice_width=1, **KW)
    assert _rows(a) == _rows(window_scan(df, ["k"], ["t", "seq"], **KW))


def test_same_plan_at_any_partition_count(spark):
    import re
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").selectExpr(
        "l_suppkey AS k", "l_shipdate AS t", "l_orderkey AS seq", "l_tax AS v", "l_linenumber AS w")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    shapes = set()
    try:
        for n in ("8", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
            a = scan(df, "k", ["t", "seq"], row_number=True, **KW)
            assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == jobs  # nothing ran
            plan = a._jdf.queryExecution().executedPlan().toString()
            shapes.add(tuple(re.findall(r"Exchange|Window|SortMergeJoin|BroadcastHashJoin|HashAggregate", plan)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(shapes) == 1


def test_only_hot_keys_are_sliced(spark):
    df = _data(spark, 5)
    parts = {}
    for r in sliced(df, ["k"], "t", 3, hot_rows=200).select("_part.key.k", "_part.slice").distinct().collect():
        parts.setdefault(r.k, set()).add(r.slice)
    assert len(parts.pop("hot")) > 10 and all(len(s) == 1 for s in parts.values()) and None in parts
    a = scan(df, "k", ["t", "seq"], row_number=True, slice_width=3, hot_rows=200, **KW)
    assert _rows(a) == _rows(window_scan(df, ["k"], ["t", "seq"], **KW))


def test_summaries_of_a_trigger_are_kept_until_released(spark):
    earlier = Earlier(lambda keys: None)
    out, after = scan_with_state(_data(spark, 6), "k", ["t", "seq"], row_number=True, slice_width=3, state=earlier, **KW)
    assert len(earlier.kept) == 1 and earlier.kept[0].is_cached
    for df in (out, after):
        assert "InMemoryTableScan" in df._jdf.queryExecution().executedPlan().toString()
    assert _rows(out) == _rows(window_scan(_data(spark, 6), ["k"], ["t", "seq"], **KW))
    earlier.release()
    assert not earlier.kept[0].is_cached
