"""Predicates, literals, identifiers and JSON values on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from recspark import model
from recspark.functions import ids
from recspark.functions import json_values as j
from recspark.functions import predicates as p


def values(df, **columns):
    got = df.select(*[c.alias(n) for n, c in columns.items()]).collect()
    return {n: [r[n] for r in got] for n in columns}


@pytest.mark.parametrize(
    "pattern, sql",
    [("a", "a"), ("a*", "a%"), ("a?", "a_"), (r"a\*", "a*"), (r"a\?", "a?"), (r"a\\", r"a\\"), ("a%", r"a\%"), ("a_", r"a\_")],
)
def test_like_pattern(pattern, sql):
    assert p.like_pattern(pattern) == sql


@pytest.mark.parametrize("pattern", ["a\\", r"a\b"])
def test_bad_like_pattern(pattern):
    with pytest.raises(ValueError):
        p.like_pattern(pattern)


def test_literal_types(spark):
    df = spark.createDataFrame([("x",), (None,)], "t string")
    t = F.col("t")
    got = values(df, eq=p.compare(t, "=", 5, "text"), ne=p.compare(t, "!=", 5, "text"), m=p.compare(t, "MATCHES", [5, True], "text"),
                 same=p.compare(t, "!=", "y", "text"), lt=p.compare(t, "<", 5, "text"))
    assert got == {"eq": [False, False], "ne": [True, True], "m": [False, False], "same": [True, None], "lt": [True, None]}
    with pytest.raises(ValueError):
        p.compare(t, "=", ["a", "b"], "text")


def test_json_comparison(spark):
    df = spark.createDataFrame([('{"v":5}',), ('{"v":"abc"}',), ('{"v":true}',), ('{"v":null}',), ("{}",)], "d string")
    v = F.try_variant_get(F.parse_json("d"), "$.v", "variant")
    got = values(df, eq=p.compare_json(v, "=", 5), ne=p.compare_json(v, "!=", 5), gt=p.compare_json(v, ">", "abb"))
    assert got["eq"] == [True, False, False, False, None]
    assert got["ne"] == [False, True, True, True, None]
    assert got["gt"] == [True, True, True, False, None]
    like = values(df, l=p.like_json(v, "*b*"))["l"]
    assert like == [False, True, False, False, None]


def test_ordered_comparison(spark):
    df = spark.createDataFrame([("DV_QUANTITY", 5), ("DV_DATE", 5), (None, None)], "k string, m int")
    k, m = F.col("k"), F.col("m").cast("decimal(38,9)")
    got = values(df, num=p.compare_ordered(k, m, "=", 5), ne=p.compare_ordered(k, m, "!=", 4), none=p.compare_ordered(k, m, "!=", "text"))
    assert got == {"num": [True, False, None], "ne": [True, False, None], "none": [False, False, False]}
    with pytest.raises(ValueError):
        p.compare_ordered(k, m, "LIKE", "x")


def test_temporal_literals(spark):
    day = dt.date(2020, 1, 2)
    m = day.toordinal() - 1
    df = spark.createDataFrame([("DV_DATE", m)], "k string, m long")
    k, c = F.col("k"), F.col("m").cast("decimal(38,9)")
    noon = dt.datetime(2020, 1, 2, 12)
    got = values(df, d=p.compare_ordered(k, c, "=", day), eq=p.compare_ordered(k, c, "=", noon), le=p.compare_ordered(k, c, "<=", noon),
                 t=p.compare_ordered(k, c, "<", dt.time(10)))
    assert got == {"d": [True], "eq": [False], "le": [True], "t": [False]}


def test_durations():
    assert p.duration_seconds("P1Y2M10DT2H30M") == 37686312
    assert p.duration_seconds("-PT1.5S") == -1.5
    assert p.duration_seconds("P2W") == 1209600
    assert p.duration_seconds("P") is None and p.duration_seconds("PT") is None and p.duration_seconds("x") is None


def test_timestamp_literals():
    assert p.timestamp_literal("2020-01-02") == dt.datetime(2020, 1, 2)
    assert p.timestamp_literal("2020-01-02T03:00:00+02:00") == dt.datetime(2020, 1, 2, 1)
    assert p.timestamp_literal("nonsense") is None


def test_uids(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "vo long, v int")
    vo, v = F.col("vo"), F.col("v")
    got = values(df, m=p.uid_predicate(vo, v, "MATCHES", ["2", "1::s::2"], "s"), n=p.uid_predicate(vo, v, "NOT MATCHES", ["2", "1::s::2"], "s"),
                 lt=p.uid_predicate(vo, v, "<", "1::s::2", "s"), ne=p.uid_predicate(vo, v, "!=", "1::s::2", "s"))
    assert got == {"m": [False, True, True], "n": [True, False, False], "lt": [True, False, False], "ne": [True, False, True]}
    for bad in ("1::other::2", "1::s", "1::s::0", "::s::1"):
        with pytest.raises(ValueError):
            p.uid_predicate(vo, v, "=", bad, "s")


def test_archetype_predicates(spark):
    df = spark.createDataFrame([("CLUSTER", ".a.v1"), ("ELEMENT", ".a.v1"), ("CLUSTER", "at0001")], "rm string, c string")
    rm, c = F.col("rm"), F.col("c")
    a = "openEHR-EHR-CLUSTER.a.v1"
    got = values(df, eq=p.archetype_predicate(rm, c, "=", a), ne=p.archetype_predicate(rm, c, "!=", a), any=p.archetype_predicate(rm, c, "MATCHES", [a, "at0001"]))
    assert got == {"eq": [True, False, False], "ne": [False, True, True], "any": [True, False, True]}
    for bad in ("openEHR-EHR-CLUSTER", "openEHR-EHR-NOTHING.a.v1", "xx"):
        with pytest.raises(ValueError):
            p.split_archetype(bad)


def test_types():
    assert model.concrete_types("ITEM") == ["CLUSTER", "ELEMENT"]
    assert "SECTION" in model.concrete_types("CONTENT_ITEM") and "SECTION" not in model.concrete_types("ENTRY")
    with pytest.raises(ValueError):
        model.concrete_types("NOTHING")


def test_change_types(spark):
    df = spark.createDataFrame([("Unknown",), ("deleted",)], "c string")
    c = F.col("c")
    got = values(df, code=ids.change_type_code(c), unknown=p.change_type_predicate(c, "=", "unknown"), by_code=p.change_type_predicate(c, "=", "523", by="code"))
    assert got == {"code": ["253", "523"], "unknown": [True, False], "by_code": [False, True]}


def test_template_versions(spark):
    data = ["a.en.v1", "a.en-US.v1.2", "a_b v2.0.3", "a.b", "a.v01", "IDCR - Notes.v0"]
    parts = ids.template_version(F.col("t"))
    got = spark.createDataFrame([(x,) for x in data], "t string").select(*[c.alias(n) for n, c in parts.items()]).collect()
    assert [tuple(r) for r in got] == [
        ("a", 1, None, None), ("a", 1, 2, None), ("a_b", 2, 0, 3), ("a.b", None, None, None), ("a.v01", None, None, None), ("IDCR - Notes", 0, None, None),
    ]


def test_is_older(spark):
    data = [((1, 2, 3), (1, 2, 3), False), ((1, 2, 2), (1, 2, 3), True), ((2, 0, 0), (1, 9, 9), False), ((1, None, None), (1, 0, None), True),
            ((1, None, None), (1, None, None), False), ((None, None, None), (1, None, None), True), ((0, 1, 0), (None, None, None), False)]
    df = spark.createDataFrame([(*a, *b) for a, b, _ in data], "a int, b int, c int, x int, y int, z int")
    got = values(df, o=ids.is_older((F.col("a"), F.col("b"), F.col("c")), (F.col("x"), F.col("y"), F.col("z"))))["o"]
    assert got == [e for _, _, e in data]


def test_semver_next(spark):
    data = [(None, None, "1.0.0"), (None, "1.2.3", "2.0.0"), ("3", None, "3.0.0"), ("3", "3.1.4", "3.2.0"), ("3.1", None, "3.1.0"), ("3.1", "3.1.4", "3.1.5"),
            ("1.0.0", None, "1.0.0"), ("1.0.0", "1.0.0", None), ("1.0.0-beta", "1.0.0-beta", "1.0.0-beta")]
    df = spark.createDataFrame([d[:2] for d in data], "r string, s string")
    assert values(df, n=ids.semver_next(F.col("r"), F.col("s")))["n"] == [d[2] for d in data]


def test_semver_order(spark):
    df = spark.createDataFrame([("1.10.0",), ("1.2.0",), ("2.0.0-beta",), ("1.2.0-a",)], "v string")
    assert [r.v for r in df.orderBy(ids.semver_key(F.col("v"))).collect()] == ["1.2.0", "1.2.0-a", "1.10.0", "2.0.0-beta"]


def test_json_arrays_keep_rows(spark):
    df = spark.createDataFrame([(1, '{"a":[{"b":[1,2]},{"b":[]}]}'), (2, '{"a":[]}'), (3, "{}")], "id int, d string")
    df = df.withColumn("d", F.parse_json("d"))
    first = j.json_path_multi(df, "d", "a", "x")
    second = j.json_path_multi(first, "x", "b", "y").select("id", j.json_path(F.col("y"), "", "int").alias("y"))
    assert rows(second) == [(1, 1), (1, 2), (1, None), (2, None), (3, None)]


def test_json_set_and_text(spark):
    df = spark.createDataFrame([('{"a":1,"b":"x"}',)], "d string").withColumn("d", F.parse_json("d"))
    got = df.select(F.to_json(j.json_set(F.col("d"), "a", F.lit("y"))), j.json_get_text(F.col("d"), "a"), j.json_get_text(F.col("d"), "c")).first()
    assert tuple(got) == ('{"a":"y","b":"x"}', "1", None)


def test_iso(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 120000),), (dt.datetime(2024, 1, 2, 3, 4, 0),)], "t timestamp_ntz")
    assert values(df, i=ids.iso_format(F.col("t")))["i"] == ["2024-01-02T03:04:05.12Z", "2024-01-02T03:04:00Z"]
