"""Top-N per group (per window end)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, group: str | list[str], score: str, n: int = 3,
          tie: str | list[str] | None = None, rank_name: str = "rk") -> DataFrame:
    """RNK1 / SRT1 / LIM1: the ``n`` rows with the highest ``score`` in each
    group, numbered from 1.  Ties go to the smaller ``tie`` value.

    ``row_number() ... <= n`` is planned with a partial ``WindowGroupLimit``
    before the shuffle, so each map task sends at most ``n`` rows per group;
    no group is ever collected into one list."""
    groups = [group] if isinstance(group, str) else list(group)
    ties = [] if tie is None else ([tie] if isinstance(tie, str) else list(tie))
    w = Window.partitionBy(*groups).orderBy(F.col(score).desc(), *[F.col(t).asc() for t in ties])
    ranked = df.withColumn(rank_name, F.row_number().over(w)).filter(F.col(rank_name) <= n)
    # rank as BIGINT (SQL's ROW_NUMBER type), cast after the limit filter so
    # the planner still recognises the group limit
    return ranked.withColumn(rank_name, F.col(rank_name).cast("bigint"))


def top_n_report(ranked: DataFrame, group: str, item: str, score: str, rank_name: str = "rk") -> DataFrame:
    """The printed report of the reference, one text per window end, built
    from at most ``n`` rows per group."""
    from ..functions import messages as m
    line = F.concat(F.lit(m.TOPN_RANK), F.col(rank_name).cast("string"), F.lit(":"), F.lit(m.TOPN_ITEM),
                    F.col(item).cast("string"), F.lit(m.TOPN_VIEWS), F.col(score).cast("string"))
    agg = ranked.groupBy(group).agg(
        F.array_sort(F.collect_list(F.struct(F.col(rank_name), line.alias("l")))).alias("_lines"))
    return agg.select(
        group,
        F.concat(F.lit(m.TOPN_RULE + "\n" + m.TOPN_TIME), F.date_format(F.col(group), "yyyy-MM-dd HH:mm:ss.S"),
                 F.lit("\n"), F.array_join(F.transform("_lines", lambda s: s["l"]), "\n"),
                 F.lit("\n" + m.TOPN_RULE + "\n")).alias("report"))
