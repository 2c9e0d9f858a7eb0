"""Record frames derived from the flat input tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.operators.contains import objects_fit
from recspark.plans.ordered import ordered

LINE_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]

# one line = nine nodes, or the first seven: (offset, parent offset, type, concept, name, attribute, depth)
LINE_NODES = [
    (0, -1, "OBSERVATION", ".line_item.v1", "line item", "content", 1),
    (1, 0, "HISTORY", "at0001", "history", "data", 2),
    (2, 1, "POINT_EVENT", "at0002", "event", "events", 3),
    (3, 2, "ITEM_TREE", "at0003", "tree", "data", 4),
    (4, 3, "ELEMENT", "at0004", "quantity", "items", 5),
    (5, 3, "ELEMENT", "at0005", "price", "items", 5),
    (6, 3, "ELEMENT", "at0006", "shipped", "items", 5),
    (7, 3, "CLUSTER", ".return_details.v1", "return", "items", 5),
    (8, 7, "ELEMENT", "at0004", "status", "items", 6),
]

NODE_COLUMNS = [
    "vo_id", "num", "num_cap", "parent_num", "citem_num", "rm_entity", "entity_concept", "entity_name",
    "entity_attribute", "depth", "dv_type", "magnitude", "value_str",
]

MAGNITUDE = T.DecimalType(18, 2)


def _days(ts):
    return F.datediff(ts.cast("date"), F.lit("0001-01-01").cast("date")).cast(MAGNITUDE)


class Tables:
    """Input tables of one folder and the record frames derived from them; every frame is lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str, group_limit: int | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.group_limit = group_limit

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def ehr(self) -> DataFrame:
        first = self.table("orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("creation_date"))
        customers = self.table("customer").select(F.col("c_custkey").alias("ehr_id"))
        return customers.join(first, F.col("o_custkey") == F.col("ehr_id"), "left").select("ehr_id", "creation_date")

    @cached_property
    def status(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").select(
            k.alias("ehr_id"),
            (k - F.when(k % 97 == 1, 1).otherwise(0)).cast("string").alias("subject_id"),
            F.when(k % 50 == 0, "9 bad").otherwise("demographic").alias("namespace"),
            (F.col("c_acctbal") >= 0).alias("is_modifiable"),
        )

    @cached_property
    def comp_version(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("vo_id"),
            F.col("o_custkey").alias("ehr_id"),
            F.lit(1).alias("sys_version"),
            F.col("o_orderdate").alias("sys_period_lower"),
            F.col("o_orderpriority").alias("template_name"),
            F.lit(".order.v1").alias("root_concept"),
        )

    @cached_property
    def template(self) -> DataFrame:
        """Template names with their uid; the name 5-LOW is left out on purpose."""
        p = F.col("o_orderpriority")
        names = self.table("orders").select(p.alias("template_id")).distinct().filter(~F.col("template_id").startswith("5"))
        return names.select(F.substring("template_id", 1, 1).cast("int").alias("template_uid"), "template_id")

    @cached_property
    def nodes(self) -> DataFrame:
        # Lines and orders are numbered together, so that all nodes of an object come out of one shuffle of these slim
        # rows and stay partitioned by object. The order comes last: its running sum is the node count of all lines.
        key, k = F.col("vo_id"), F.col("t.k")
        lines = self.table("lineitem").select(F.col("l_orderkey").alias("vo_id"), *LINE_ORDER).withColumns(
            {"is_order": F.lit(False), "w": F.when(F.col("l_returnflag") == "R", 9).otherwise(7)}
        )
        orders = self.table("orders").select(F.col("o_orderkey").alias("vo_id"), "o_orderdate").withColumns(
            {"is_order": F.lit(True), "w": F.lit(0)}
        )
        rows = lines.unionByName(orders, allowMissingColumns=True)
        # the date is no more than a further column here, which lets all readers share one exchange
        rows = ordered(rows, ["vo_id"], ["is_order", *LINE_ORDER, "o_orderdate"], sums={"upto": "w"}, limit=self.group_limit)

        def pattern(nodes):
            names = ("k", "p", "rm", "concept", "name", "attr", "depth")
            kinds = ("int", "int", "string", "string", "string", "string", "int")
            return F.array(*[F.struct(*[F.lit(v).cast(kind).alias(n) for n, kind, v in zip(names, kinds, node, strict=True)]) for node in nodes])

        of_order = pattern([(-2, 0, "COMPOSITION", ".order.v1", "Order", None, 0), (-1, 0, "EVENT_CONTEXT", None, None, "context", 1)])
        nodes = F.when(F.col("is_order"), of_order).when(F.col("w") == 9, pattern(LINE_NODES)).otherwise(pattern(LINE_NODES[:7]))
        base = F.col("upto") + 2 - F.col("w")
        total = F.when(key.isNotNull(), F.col("upto")).otherwise(0)  # orders without a key have no lines
        is_line = k >= 0
        return rows.withColumns({"base": base, "total": total}).select("*", F.explode(nodes).alias("t")).select(
            "vo_id",
            F.when(is_line, F.col("base") + k).otherwise(k + 2).cast("int").alias("num"),
            F.when(k == -2, F.col("total") + 1).when(k == -1, 1).when(k <= 3, F.col("base") + F.col("w") - 1)
            .when(k == 7, F.col("base") + 8).otherwise(F.col("base") + k).cast("int").alias("num_cap"),
            F.when(k <= 0, 0).otherwise(F.col("base") + F.col("t.p")).cast("int").alias("parent_num"),
            F.when(k == -2, None).when(k <= 0, 0).when(k == 8, F.col("base") + 7).otherwise(F.col("base")).cast("int").alias("citem_num"),
            F.col("t.rm").alias("rm_entity"),
            F.col("t.concept").alias("entity_concept"),
            F.col("t.name").alias("entity_name"),
            F.col("t.attr").alias("entity_attribute"),
            F.col("t.depth").alias("depth"),
            F.when(k == 4, "DV_COUNT").when(k == 5, "DV_QUANTITY").when(k.isin(-1, 6), "DV_DATE").when(k == 8, "DV_CODED_TEXT").alias("dv_type"),
            F.when(k == 4, F.col("l_quantity").cast(MAGNITUDE))
            .when(k == 5, F.col("l_extendedprice").cast(MAGNITUDE))
            .when(k == 6, _days(F.col("l_shipdate")))
            .when(k == -1, _days(F.col("o_orderdate")))
            .alias("magnitude"),
            F.when(k == 6, F.col("l_shipdate").cast("date").cast("string")).when(k == 8, F.col("l_linestatus"))
            .when(k == -1, F.col("o_orderdate").cast("date").cast("string")).alias("value_str"),
        )

    @cached_property
    def blocks(self) -> bool:
        """Whether containment joins need blocks: some object has more nodes than one block."""
        total = self.table("lineitem").groupBy("l_orderkey").agg(F.sum(F.when(F.col("l_returnflag") == "R", 9).otherwise(7)).alias("n"))
        return not objects_fit(total.select(F.lit(0).alias("num"), (F.col("n") + 1).alias("num_cap")))

    @cached_property
    def versions(self) -> DataFrame:
        kind = (
            F.when(F.col("event_type") == "click", 0).when(F.col("event_type") == "error", 1)
            .when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "signup", 3).otherwise(4)
        )
        e = self.table("events").select("event_id", "ts", "user_id", (F.col("user_id") * 10 + kind).alias("vo_id"))
        e = ordered(
            e, ["vo_id"], ["ts", "event_id"], number="n", lag={"prev_id": "event_id"}, lead={"sys_period_upper": "ts"},
            limit=self.group_limit,
        )
        deleted = F.col("prev_id").isNotNull() & (F.col("event_id") % 7 == 0) & (F.col("prev_id") % 7 != 0)
        return e.withColumn("sys_deleted", deleted).select(
            "vo_id",
            F.col("user_id").alias("ehr_id"),
            (F.col("user_id") * 1000 + F.dayofmonth("ts")).alias("contribution_id"),
            F.col("event_id").alias("audit_id"),
            F.col("n").cast("int").alias("sys_version"),
            F.col("ts").alias("sys_period_lower"),
            "sys_period_upper",
            "sys_deleted",
            (F.col("sys_period_upper").isNull() & ~F.col("sys_deleted")).alias("is_head"),
            F.when(F.col("n") == 1, "creation").when(F.col("sys_deleted"), "deleted")
            .when(F.col("event_id") % 5 == 0, "amendment").otherwise("modification").alias("change_type"),
        )

    @cached_property
    def version_head(self) -> DataFrame:
        return self.versions.filter("is_head").drop("is_head", "sys_period_upper", "sys_deleted")

    @cached_property
    def version_history(self) -> DataFrame:
        return self.versions.filter("NOT is_head").drop("is_head")

    @cached_property
    def audit(self) -> DataFrame:
        """One row per event: who, when, what."""
        return self.table("events").select(
            F.col("event_id").alias("audit_id"),
            F.col("event_type").alias("event_type"),
            F.col("ts").alias("time_committed"),
            F.col("user_id").alias("committer"),
            F.col("props").alias("description"),
            # four codes in turn, so that audits can be filtered by type without the version chain
            F.when(F.col("event_id") % 4 == 0, "creation").when(F.col("event_id") % 4 == 1, "amendment")
            .when(F.col("event_id") % 4 == 2, "modification").otherwise("deleted").alias("change_type"),
        )

    @cached_property
    def contribution(self) -> DataFrame:
        e = self.table("events")
        return e.select(
            (F.col("user_id") * 1000 + F.dayofmonth("ts")).alias("contribution_id"), F.col("user_id").alias("ehr_id")
        ).distinct()

    @cached_property
    def changes(self) -> DataFrame:
        """The commits that lead to ``versions``."""
        return self.versions.select(
            F.col("audit_id").alias("change_id"), "vo_id", "ehr_id", "contribution_id", "change_type",
            (F.col("sys_version") - 1).alias("preceding_version"), F.col("sys_period_lower").alias("committed_at"),
        )

    @cached_property
    def folder_nodes(self) -> DataFrame:
        groups = self.table("orders").select(
            F.col("o_custkey").alias("ehr_id"), F.year("o_orderdate").alias("y"), F.col("o_orderstatus").alias("s")
        ).distinct()
        rows = groups.unionByName(groups.select("ehr_id", "y", F.lit("").alias("s")).distinct())
        # distinct (year, status) pairs of one owner: a handful of rows, whatever the number of orders
        by_owner = Window.partitionBy("ehr_id")
        by_year = Window.partitionBy("ehr_id", "y")
        n = rows.withColumn("num", F.row_number().over(by_owner.orderBy("y", "s")))
        year = F.col("s") == ""
        folders = n.select(
            "ehr_id",
            F.lit(1).alias("folder_idx"),
            "num",
            F.when(year, F.max("num").over(by_year)).otherwise(F.col("num")).alias("num_cap"),
            F.when(year, 0).otherwise(F.min("num").over(by_year)).alias("parent_num"),
            F.when(year, F.col("y").cast("string")).otherwise(F.col("s")).alias("entity_name"),
            F.when(year, 1).otherwise(2).alias("depth"),
            "y",
            "s",
        )
        roots = rows.groupBy("ehr_id").agg(F.count(F.lit(1)).cast("int").alias("num_cap")).select(
            "ehr_id", F.lit(1).alias("folder_idx"), F.lit(0).alias("num"), "num_cap", F.lit(0).alias("parent_num"),
            F.lit("root").alias("entity_name"), F.lit(0).alias("depth"), F.lit(None).cast("int").alias("y"),
            F.lit(None).cast("string").alias("s"),
        )
        return folders.unionByName(roots)

    @cached_property
    def folder_items(self) -> DataFrame:
        leaves = self.folder_nodes.filter("depth = 2").select("ehr_id", "folder_idx", "num", "y", "s")
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("item_vo_id"), F.col("o_custkey").alias("ehr_id"), F.year("o_orderdate").alias("y"),
            F.col("o_orderstatus").alias("s"),
        )
        return orders.join(leaves, ["ehr_id", "y", "s"]).select("ehr_id", "folder_idx", "num", "item_vo_id")

    @cached_property
    def item_tag(self) -> DataFrame:
        labels = self.table("labels")
        d = F.col("doc_id")

        def rows(i: int, key: str) -> DataFrame:
            return labels.select(
                (d * 2 + i).alias("id"), (d % 50).alias("ehr_id"), d.alias("target_vo_id"),
                F.lit("COMPOSITION").alias("target_type"), F.lit(key).alias("key"), F.col(key).cast("string").alias("value"),
                F.when(d % 3 == 0, F.lit(None).cast("string")).otherwise("/content").alias("target_path"),
            )

        return rows(0, "quality").unionByName(rows(1, "toxic"))

    @cached_property
    def definition(self) -> DataFrame:
        """Stored definitions with semantic versions, made from the parts."""
        k = F.col("p_partkey")
        semver = F.concat(
            (F.col("p_size") % 4 + 1).cast("string"), F.lit("."), (k % 12).cast("string"), F.lit("."),
            (k % 5).cast("string"), F.when(k % 7 == 0, "-beta").otherwise(""),
        )
        return self.table("part").select(
            F.col("p_brand").alias("namespace"), F.col("p_type").alias("name"), semver.alias("semver"), k.alias("k")
        ).groupBy("namespace", "name", "semver").agg(F.min("k").cast("string").alias("text"))
