"""Aggregates over JSON values and implicit group keys."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from recspark.operators import aggregates as a

# in ascending order
JSON = ["null", '""', '"1"', '"B"', '"a"', '"ä"', "-1e300", "-5", "0.1", "1", "9007199254740993", "9007199254740994", "12345678901234567890123", "1e300",
        "false", "true", "[]", "[0]", "[1, 2]", "{}", '{"a": 1}', '{"a": 1, "b": null}']


@pytest.fixture
def frame(spark):
    def make(texts):
        return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("v", F.parse_json("t"))

    return make


def ends(df):
    r = df.agg(F.to_json(a.agg_min_json(F.col("v"))).alias("lo"), F.to_json(a.agg_max_json(F.col("v"))).alias("hi")).first()
    return r.lo, r.hi


def same(shown, text):
    import json

    return json.loads(shown, parse_float=float) == json.loads(text, parse_float=float)


def test_order_of_types_and_values(frame):
    for seed in range(6):
        rng = random.Random(seed)
        some = sorted(rng.sample(range(len(JSON)), 5))
        texts = [JSON[i] for i in some] + [None]
        rng.shuffle(texts)
        lo, hi = ends(frame(texts).repartition(3))
        assert same(lo, JSON[some[0]]) and same(hi, JSON[some[-1]]), (some, lo, hi)
    assert ends(frame([None, None])) == (None, None)
    key = frame(JSON).orderBy(a.json_order_key(F.col("v"))).collect()
    assert [r.t for r in key] == JSON


def test_sums_of_numbers_only(frame):
    df = frame(['"5"', "1.25", "2", "true", "null", None, "[7]", "1e3", "0.000000001"])
    r = df.agg(a.agg_sum_json(F.col("v")).alias("s"), a.agg_avg_json(F.col("v")).alias("m")).first()
    assert r.s == Decimal("1003.250000001") and r.m == Decimal("250.812500")
    r = frame(['"5"', None, "true"]).agg(a.agg_sum_json(F.col("v")).alias("s"), a.agg_avg_json(F.col("v")).alias("m")).first()
    assert r.s is None and r.m is None
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST|OVERFLOW|OUT_OF_RANGE"):
        frame(["1e300"]).agg(a.agg_sum_json(F.col("v"))).collect()


def test_implicit_keys(spark):
    df = spark.createDataFrame(
        [(1, 1, "ELEMENT", "at1", 3, 3, "x", 5), (1, 1, "ELEMENT", "at1", 4, 4, "x", 7), (1, 2, "ELEMENT", "at1", 3, 3, "y", 1), (2, 1, "CLUSTER", ".c.v1", 3, 9, "x", 2)],
        "vo_id long, sys_version int, n_rm_entity string, n_entity_concept string, n_num int, n_num_cap int, name string, size int",
    )
    total = [F.sum("size").alias("total")]
    uid, node = a.Projected("uid", "uid", system="s"), a.Projected("object", "node", prefix="n")
    kind, label = a.Projected("archetype", "id", prefix="n"), a.Projected("constant", "label", F.lit("k"))
    name = a.Projected("column", "name", F.upper("name"))

    def grouped(*paths, **kw):
        return [tuple(r) for r in a.group_by_projected(df, paths, total, **kw).collect()]

    assert sorted(grouped(uid, label)) == [("1::s::1", "k", 12), ("1::s::2", "k", 1), ("2::s::1", "k", 2)]
    assert len(grouped(node)) == 3 and len(grouped(node, uid)) == 4
    assert sorted(r[1] for r in grouped(kind)) == [2, 13]
    assert sorted(grouped(name, kind))[0][0] == "X"
    assert grouped(label) == [("k", 15)]
    assert [r[-1] for r in grouped(uid, order_magnitude=F.col("size"))] == [1, 2, 5, 7]
