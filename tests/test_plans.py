"""Plan guarantees for every registered key (physical plans only, nothing is executed)."""

import re

import __spark_entry__ as E

MODEL_KEYS = {"ets_fit", "ets_season", "ets_forecast", "model_selection", "model_evaluation", "model_summary", "revenue_forecast",
              "revenue_forecast_total", "pacf", "inventory_risk_forecast"}
LLM = re.compile(r"op\d+_|pipeline$")


def test_no_cartesian_and_python_only_in_models(spark):
    for name, fn in E.queries().items():
        if LLM.match(name):  # these run jobs while they are planned; tests/llm covers them
            continue
        plan = fn(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        if name not in MODEL_KEYS:
            assert "FlatMapGroupsInPandas" not in plan, name
