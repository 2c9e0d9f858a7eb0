"""Ordered computations agree with plain windows, whatever the group sizes."""

import random

from pyspark.sql import functions as F

from conftest import rows
from recspark.plans.ordered import large_groups, ordered, running_max
from recspark.sources.tables import Tables


def _frame(spark):
    rnd = random.Random(7)
    data = [(1, i, rnd.randrange(1000)) for i in range(700)] + [(k, i, rnd.randrange(50)) for k in range(2, 40) for i in range(5)]
    data += [(None, i, i) for i in range(300)]
    rnd.shuffle(data)
    return spark.createDataFrame(data, "k int, o int, v int")


def test_sliced_groups_equal_windows(spark):
    df = _frame(spark)
    args = dict(number="n", sums={"s": "v"}, maxes={"m": "v"}, lag={"before": "v"}, lead={"after": "v"})
    assert large_groups(df, ["k"], 100)[1] == 1000
    assert large_groups(df, ["k"], 1000) is None
    plain = ordered(df, ["k"], ["o"], **args)
    sliced = ordered(df, ["k"], ["o"], **args, limit=100)
    assert plain.columns == sliced.columns
    assert rows(plain) == rows(sliced)


def test_sliced_plan_cuts_the_large_group(spark):
    df = _frame(spark)
    sliced = ordered(df, ["k"], ["o"], number="n", limit=100)
    text = sliced._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in text


def test_running_max_over_blocks(spark):
    rnd = random.Random(3)
    data = [(k, i, rnd.randrange(10**6)) for k, n in ((1, 5000), (2, 3), (3, 1500)) for i in range(n)]
    df = spark.createDataFrame(data, "k int, p int, v int")
    for inclusive in (True, False):
        got = {(r.k, r.p): r.m for r in running_max(df, ["k"], "p", {"m": F.col("v")}, inclusive).collect()}
        for k in (1, 2, 3):
            best = None
            for _, p, v in sorted(x for x in data if x[0] == k):
                now = v if best is None else max(best, v)
                assert got[(k, p)] == (now if inclusive else best)
                best = now


def test_frames_do_not_depend_on_group_limit(spark, tables):
    small = Tables(spark, tables.sf_dir, group_limit=20)
    assert rows(small.versions) == rows(tables.versions)
    assert small.nodes.exceptAll(tables.nodes).isEmpty()
    assert tables.nodes.exceptAll(small.nodes).isEmpty()
