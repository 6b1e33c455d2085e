"""Text outputs of the reference programs, as column expressions.

Results are DataFrames with typed columns; the message column renders the
same information the reference prints.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts the reference prints, kept verbatim.
TEMP_HIGH = "温度过高"          # temperature too high
TEMP_LOW = "温度过低"           # temperature too low
REPORT_TITLE = "报表结果："      # report result:
REPORT_TEMP = "温度："          # temperature:
METRIC_LABEL = {"acid": "酸度", "cons": "粘稠度", "water_rate": "含水量"}  # acid, consistency, water content
FIRST_TIME = "第一次"           # first time
SECOND_TIME = "第二次"          # second time
TOO_HIGH = "过高"               # too high
SIDE_TAG_6 = "6传感器id："       # sensor 6 id:
SIDE_TAG_1 = "1传感器id："       # sensor 1 id:
TOPN_RANK = "No"                # rank number
MAIN_TAG, TAG_6, TAG_1 = "main", "tmp-output", "qa-output"   # outputs of the sensor split
TOPN_RULE = "===================================="
TOPN_TIME = "时间: "            # time:
TOPN_ITEM = "  商品ID="         # item id =
TOPN_VIEWS = "  浏览量="        # views =


def jvm_to_int(c: Column) -> Column:
    """Double to int as the JVM's ``toInt``: truncation toward zero, clamped
    to the int range, NaN to 0 (an ANSI cast would raise instead)."""
    clamped = F.least(F.greatest(c, F.lit(-2147483648.0)), F.lit(2147483647.0))
    return F.when(F.isnan(c), F.lit(0)).otherwise(clamped.cast("int"))


def temp_alert(id_col: str, time_col: str, temp_col: str, kind_col: str) -> Column:
    """``id,time,<temp truncated to int>; 温度过高|温度过低``."""
    label = F.when(F.col(kind_col) == "high", F.lit(TEMP_HIGH)).otherwise(F.lit(TEMP_LOW))
    return F.concat(F.concat_ws(",", F.col(id_col).cast("string"), F.col(time_col),
                                jvm_to_int(F.col(temp_col)).cast("string")),
                    F.lit("; "), label)


def daily_report(day_col: str, avg_col: str) -> Column:
    """``报表结果：`` / ``温度：yyyy-MM-dd <mean %.2f>`` (Java half-up rounding)."""
    return F.concat(F.lit("\n" + REPORT_TITLE + "\n" + REPORT_TEMP),
                    F.date_format(F.col(day_col), "yyyy-MM-dd"), F.lit(" "),
                    F.format_string("%.2f", F.col(avg_col)), F.lit("\n"))


def breach_alert(id_col, metric_col, time1, v1, time2, v2) -> Column:
    """Two lines: the first and the second reading over the baseline, with
    the metric's own label."""
    label = F.coalesce(*[F.when(F.col(metric_col) == k, F.lit(v)) for k, v in METRIC_LABEL.items()])
    line = lambda t, v, nth: F.concat_ws(",", F.col(id_col).cast("string"), F.col(t),
                                         F.concat(label, F.lit(":"), F.col(v).cast("string"),
                                                  F.lit(" " + nth), label, F.lit(TOO_HIGH)))
    return F.concat_ws("\n", line(time1, v1, FIRST_TIME), line(time2, v2, SECOND_TIME))
