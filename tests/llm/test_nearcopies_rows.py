"""What the joins of strays make: rows of shingles that are shared, not of all that a scope holds."""

from pyspark.sql import functions as F

from tessera.llm import nearcopies


def nodes(plan):
    """The physical plan's nodes, those of finished stages too."""
    name = plan.getClass().getSimpleName()
    inner = [plan.executedPlan()] if name == "AdaptiveSparkPlanExec" else [plan.plan()] if name.endswith("QueryStageExec") else [plan.children().apply(k) for k in range(plan.children().size())]
    return [plan, *(n for x in inner for n in nodes(x))]


def made(df):
    """The rows, and the most rows that a join on shingles made."""
    rows = df.collect()
    joins = [n for n in nodes(df._jdf.queryExecution().executedPlan()) if "Join" in n.getClass().getSimpleName() and "shingle" in n.simpleString(200)]
    return rows, max(int(n.metrics().apply("numOutputRows").value()) for n in joins)


def test_shingles_of_one_key_are_not_joined(spark):
    alone = lambda k, n: [k * 1000 + i for i in range(n)]
    # 40 strays of 100 shingles, each with one that all have and 39 of its own; two that share 25 and may be similar, one of the main component
    rows = [(0, k, 100, k, 60, [-1, *alone(k, 39)]) for k in range(1, 41)]
    twins = list(range(-100, -75))
    rows += [(0, 50, 100, 50, 70, [*twins, *alone(50, 5)]), (0, 51, 100, 51, 70, [*twins, *alone(51, 5)]), (0, 60, 100, 0, 100, [])]
    scope = spark.createDataFrame(rows, "main long, key long, n long, root long, both long, rest array<long>")
    found, most = made(nearcopies._strays(scope))
    assert sorted(map(tuple, found)) == [(50, 51)]
    assert scope.agg(F.sum(F.size("rest"))).first()[0] == 1660 and most <= 90
