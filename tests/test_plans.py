"""Plans of registered queries, those of the tables they write on the way included."""

import re
import sys

import pytest

from tidemark.operators import materialize as M
from tidemark.plans import registry

SF = "/root/testdata/sf0.001"
KEYS = ["drop_blank_keys", "left_join_multikey", "left_join_calendar", "calendar_backfill", "date_key_parse", "fill_zero",
        "cast_if_needed", "exclude_values", "drop_all_null", "sum_by_keys", "multi_sum", "mean_by_keys", "sales_fact", "rfm_scores",
        "sales_fact_final", "price_deciles", "lag_gap_rows", "rev_breakdown", "lead_owner_enrich", "flatten_event", "latest_per_key",
        "cost_per_booking", "booking_heatmap", "rpt_sales_temp_year", "hc_staff_vs_load"]
NEVER = re.compile(r"PythonUDF|EvalPython|InPandas|InArrow|PythonMapInArrow|CartesianProduct|BroadcastNestedLoopJoin")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def written(monkeypatch):
    """Plans of the tables that are written while a query is built."""
    plans, write = [], M.materialize

    def noting(df, name="stage"):
        plans.append(plan_of(df))
        return write(df, name)

    registry.load_all()
    for module in [m for n, m in sys.modules.items() if n.startswith("tidemark.") and getattr(m, "materialize", None) is write]:
        monkeypatch.setattr(module, "materialize", noting)
    return plans


def single_partition_inputs(plan: str) -> list[str]:
    """What stands right below each exchange into one partition."""
    lines = plan.splitlines()
    return [lines[i + 1] for i, x in enumerate(lines[:-1]) if "Exchange SinglePartition" in x and "Broadcast" not in x]


@pytest.mark.parametrize("key", KEYS)
def test_no_python_and_no_cartesian(spark, written, key):
    """Built-in expressions only, no cartesian or nested-loop join, in the result and in what is written before it."""
    final = plan_of(registry.QUERIES[key](spark, SF))
    for plan in [*written, final]:
        found = NEVER.search(plan)
        assert not found, f"{key}: {found[0]}\n{plan}"


@pytest.mark.parametrize("key", KEYS[:12])
def test_rows_do_not_meet_in_one_partition(spark, written, key):
    """Only partial aggregates may pass into one partition."""
    for plan in [*written, plan_of(registry.QUERIES[key](spark, SF))]:
        assert all("partial_" in x for x in single_partition_inputs(plan)), plan
