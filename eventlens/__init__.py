"""eventlens: event and sensor analytics on Spark DataFrames and streams.

Main entry points::

    from pyspark.sql import functions as F
    from eventlens import build_session, parsing, windows, ranking, alerts, select, tables
    spark = build_session("local[*]")
    temps = parsing.parse_temperature(parsing.prefix_filter(spark.read.text(path), "T1"))
    daily = windows.window_mean(temps, "id", "ts", "temp", "1 day")
    warn = alerts.running_mean_alerts(temps.withColumn("seq", F.monotonically_increasing_id()))

Registered queries (one per reference operator) are in ``eventlens.plans.catalog``.
"""

from .functions import parsing
from .operators import alerts, ranking, select, udf, windows
from .session import build_session, scratch_path
from .sources import files, tables

__version__ = "0.1.0"

__all__ = ["alerts", "build_session", "files", "parsing", "ranking", "scratch_path", "select", "tables",
           "udf", "windows"]

# functions and processors reach Python workers by value: executors need the
# third-party packages, but no copy of this one
import sys as _sys  # noqa: E402

from pyspark import cloudpickle as _cloudpickle  # noqa: E402

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
