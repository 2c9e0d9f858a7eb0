"""Work that must not grow with the size of the tables: shuffles, passes over documents, tasks."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from recspark.catalog.base import BUILDERS
from recspark.operators import contains as c
from recspark.operators import quality as q
from recspark.sources.store import _arranged, read_nodes, write_nodes
from recspark.streaming import checks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


KIND = "vo_id long, num int, parent_num int, rm_entity string"
NODES = [
    (1, 0, 0, "COMPOSITION"), (1, 1, 0, "SECTION"), (1, 1, 0, "CLUSTER"), (1, 2, 1, "SECTION"), (1, 3, 1, "ELEMENT"), (1, 4, 9, "SECTION"),
    (1, 5, -1, "SECTION"), (1, 6, -1, "ITEM_TREE"), (1, 7, None, "SECTION"), (2, 0, 0, "SECTION"), (2, -1, 0, "COMPOSITION"), (2, 1, -1, "SECTION"),
    (None, 0, 0, "FOLDER"), (None, 1, 0, "FOLDER"), (3, 0, 0, None), (3, 1, 0, "SECTION"), (3, None, 0, "SECTION"), (3, 0, 0, "COMPOSITION"),
]


def test_structure_check_moves_nodes_once(spark, tables):
    found = plan(BUILDERS["L8_check_structure"](tables))
    assert found.count("Exchange hashpartitioning") == 1 and "Join" not in found


def test_structure_check_of_repeated_and_missing_parents(spark):
    """Two nodes with one number are both parents; null keys have none; a parent may lack its type."""
    got = rows(q.check_structure(spark.createDataFrame(NODES, KIND)).select("vo_id", "num", "message"))
    assert got == sorted([
        (1, 1, "not allowed: COMPOSITION>CLUSTER"), (1, 2, "not allowed: CLUSTER>SECTION"), (1, 3, "not allowed: SECTION>ELEMENT"), (1, 4, "parent does not exist"),
        (1, 5, "not allowed without a parent: SECTION"), (2, 0, "not a root: SECTION"), (2, 1, "not allowed without a parent: SECTION"),
        (None, 1, "parent does not exist"), (3, 1, "parent does not exist"),
    ], key=repr)


def test_nodes_by_object_are_written_without_a_shuffle(tables):
    one = plan(tables.nodes).count("Exchange hashpartitioning")
    written = plan(_arranged(tables.nodes, ["vo_id"], 8))
    assert one == 1 and written.count("Exchange") == 1
    assert written.count("Sort [") == plan(tables.nodes).count("Sort [") + 1


def test_other_nodes_are_moved_to_write_them(spark, tmp_path):
    nodes = spark.createDataFrame([*NODES, *NODES[:3]], KIND).repartition(3)
    made = _arranged(nodes, ["vo_id"], 4)
    assert "Exchange hashpartitioning(bucket" in plan(made)
    write_nodes(nodes, str(tmp_path / "n"), buckets=4)
    back = read_nodes(spark, str(tmp_path / "n"))
    assert rows(back) == rows(nodes) and back.columns == nodes.columns
    places = made.withColumns({"p": F.spark_partition_id(), "at": F.monotonically_increasing_id()}).collect()
    assert len({(r.vo_id, r.p) for r in places}) == len({r.vo_id for r in places})
    keys = [(r.p, r.bucket, r.vo_id, r.num) for r in sorted(places, key=lambda r: r.at) if r.vo_id and r.num is not None]
    assert keys == sorted(keys)


@pytest.mark.parametrize("local", [None, "node"])
def test_semi_join_reads_its_rows_twice(spark, local):
    kind = "vo_id long, num int, num_cap int, citem_num int, rm_entity string"
    made = [(1, 0, 3, None, "A"), (1, 1, 2, 0, "A"), (1, 2, 2, 0, "B"), (1, 3, 3, 0, "B"), (1, 1, 2, 0, "A"), (2, 0, 0, 0, "A"), (None, 0, 1, 0, "A"), (None, 1, 1, 0, "B"), (3, 0, None, 0, "A"), (3, 1, 1, 0, "B")]
    nodes = spark.createDataFrame([*made, made[2]], kind)
    a, b = (c.nodes_as(nodes, x, where=F.col("rm_entity") == x.upper(), columns=["rm_entity"]) for x in "ab")
    got = c.contains(a, "a", b, "b", how="left_semi", local=local)
    assert got.columns == a.columns
    assert rows(got.select("vo_id", "a_num", "a_rm_entity")) == ([(1, 0, "A")] if local is None else []) + [(1, 1, "A")] * 2
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 4


def test_documents_of_one_file_are_flattened_by_all_cores(spark, tmp_path):
    doc = F.struct(F.lit("COMPOSITION").alias("_type"), F.array(F.struct(F.lit("ELEMENT").alias("_type"))).alias("content"))
    docs = spark.range(40).coalesce(1).select("id", doc.alias("doc"))
    docs.write.parquet(f"{tmp_path}/in")
    seen = []

    def pattern(nodes):
        seen.append(nodes.rdd.getNumPartitions())
        return nodes.filter("rm_entity = 'ELEMENT' AND id % 3 = 0")

    stream = spark.readStream.schema(docs.schema).parquet(f"{tmp_path}/in")
    checks.stream_contains(stream, "id", "doc", pattern, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert seen == [spark.sparkContext.defaultParallelism]
    assert rows(spark.read.parquet(f"{tmp_path}/out/batch=0").select("id")) == sorted(((i,) for i in range(0, 40, 3)), key=repr)
