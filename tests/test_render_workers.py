"""Columns of bytes are rendered in one Python worker of a task."""

from streamfuse.functions.render import render_binary


def test_all_columns_go_to_one_python_worker(spark):
    schema = "a binary, b array<binary>, c map<string,binary>, n int"
    df = spark.createDataFrame([(b"\0\1", [b"\2", None], {"x": b"\3"}, 7), (None, None, None, None)], schema).repartition(2)
    shown = render_binary(df)
    plan = shown._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert {tuple(r) for r in shown.selectExpr("a", "b[0]", "b[1]", "c['x']", "n").collect()} == {
        ("12", "3", None, "4", 7), (None, None, None, None, None)
    }
