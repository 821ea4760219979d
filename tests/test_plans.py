"""Plan guards: the scale properties the design relies on."""

import re

import __spark_entry__ as entry
from clicklake import queries
from clicklake.operators import ordered, sessionize, validate
from tests.helpers import bronze_df

SF = "/root/testdata/sf0.001"


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def _shuffles(plan):
    return len(re.findall(r"(?<!Broadcast)Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)",
                          plan))


def test_runs_take_one_exchange_and_one_sort_of_the_events(spark):
    act = queries.actionable(spark, SF)
    runs = ordered.keyed_runs(act, sessionize.KEY_FIELDS, sessionize.EVENT_ORDER)
    plan = runs._jdf.queryExecution().executedPlan().toString()
    assert _shuffles(plan) == 1 and len(re.findall(r"\bSort \[", plan)) == 1 and "Window" not in plan and "Join" not in plan


def test_windows_and_joins_see_cut_keys_only(spark):
    """Rows of keys inside a piece pass straight through: every window reads the rows flagged as edges."""
    for name in ("islands", "user_actions", "run_closing_event"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        union = plan.index("Union")
        inside = plan[union:].split("\n:- ", 1)[1].split("\n+- ", 1)[0]
        assert "Window" not in inside and "Join" not in inside and "Aggregate" not in inside, name


def test_valid_scan_pushes_null_tests_and_stays_in_generated_code(spark, tmp_dir):
    rows = [("1", "u", "m", "video_start", "d", 0, "IN"), (None, "u", "m", "video_pause", "d", 5, "IN")]
    bronze_df(spark, rows).write.parquet(f"{tmp_dir}/bronze")
    valid, quarantined = validate.split(spark.read.parquet(f"{tmp_dir}/bronze"))
    plan = _final_plan(valid)
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert all(f"IsNotNull({c})" in pushed for c in ("event_id", "user_id", "geo_location.country"))
    assert re.search(r"\*\(\d+\) Filter", plan) and "lambda" not in plan
    assert [r.event_id for r in valid.collect()] == ["1"] and [r.validation_errors for r in quarantined.collect()] == [["event_id_is_null"]]


def test_checks_skip_the_frequency_branch(spark):
    plan = _final_plan(entry.queries()["dq_checks"](spark, SF))
    assert _shuffles(plan) == 1 and "BroadcastExchange" not in plan
