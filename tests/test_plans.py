"""Final plans: what is read and exchanged how often."""

import re

import pytest

from eventlens.plans import catalog

SF = "/root/testdata/sf0.001"


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["running_mean_alerts", "window_mean_alerts", "breach_alerts_keep", "breach_alerts_drop"])
def test_ordered_scans_exchange_their_rows_once(spark, name):
    """One scan and one exchange of the rows, reused for the summaries; what
    else is exchanged are summaries (one row per slice)."""
    plan = _final_plan(catalog.queries()[name](spark, SF))
    assert plan.count("FileScan") == 1
    assert len(re.findall(r"ReusedExchange", plan)) == 1
    assert len(re.findall(r"(?<!\], )Exchange hashpartitioning\(_part#", plan)) == 1
