"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from starwash.llm import simhash
from starwash.operators import dedupe, fill, ordering, star
from starwash.plans import order_warehouse as warehouse, reports
from starwash.sources.staging import stage
from starwash.workload.queries import QUERIES
from starwash.workload.views import dirty


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, small):
    """The plan of every query over raw tables (the ones that stage first are seen from there on)."""
    return {name: plan(q(spark, small)) for name, q in QUERIES.items()}


def test_no_python_and_no_cross_join(plans):
    for name, text in plans.items():
        for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in text, (name, node)


def test_only_bounded_data_meets_in_one_task(plans):
    """A window without partitions only numbers calendar days or adds up chunk sizes."""
    for name, text in plans.items():
        lone = re.findall(r"windowspecdefinition\((\w+)#\d+L? (?:ASC|DESC)", text)
        assert set(lone) <= {"_chunk", "_day"}, (name, lone)


def test_keep_first_limits_groups_before_the_shuffle(spark, small):
    df = dirty(spark, small, "sales", ["Sale_ID", "Quantity"], order="ord")
    for usable in (None, F.col("Quantity").isNotNull()):
        text = plan(dedupe.keep_first(df, "Sale_ID", "ord", usable))
        partial, shuffle = text.index("row_number(), 1, Partial"), text.index("Exchange hashpartitioning(Sale_ID")
        assert text.index("row_number(), 1, Final") < shuffle < partial


def test_first_values_need_no_sort_and_no_struct_key(spark, small, monkeypatch):
    """Every job that fills or looks up first values, up to each table it stages on the way."""
    staged = []

    def seen(df, real=stage):
        staged.append(plan(df))
        return real(df)

    for module in (ordering, fill, star):
        monkeypatch.setattr(module, "stage", seen)
    sales = dirty(spark, small, "sales", ["Store_Code", "Region", "Product_Name", "Category"], order="ord")
    assert dict(sales.dtypes)["ord"] == "bigint"
    staged.clear()  # the ordinal itself is made by sorting
    for out in (
        fill.fill_from_same_key(sales, "Store_Code", "Region", "ord"),
        star.build_filled_dimension(sales, "Product_Name", "Store_Code", "Category", "none", "id", "ord"),
        ordering.fill_within_group(sales, "Product_Name", "Category", "ord"),
    ):
        staged.append(plan(out))
    assert len(staged) >= 8
    assert not any("SortAggregate" in text for text in staged)
    assert not any(re.search(r"Sort \[struct|min\(struct|min_by|max_by", text) for text in staged)


def test_scan_reads_only_what_is_needed(spark, small):
    text = plan(QUERIES["parse_dates_multi"](spark, small))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["l_linenumber", "l_orderkey", "l_shipdate"]


def test_filter_reaches_the_staged_files(spark):
    df = stage(spark.range(1000).selectExpr("id", "id % 7 as k"))
    assert "PushedFilters: [IsNotNull(k), EqualTo(k,3)]" in plan(df.filter("k = 3"))


def test_small_dimension_is_broadcast_and_large_one_is_not(spark):
    facts = stage(spark.range(1000).selectExpr("id", "cast(id % 10 as string) as k"))
    dim = stage(spark.range(10).selectExpr("cast(id as string) as name", "id as dim_id"))
    joined = star.lookup_id(facts, F.col("k"), dim, F.col("name"), "dim_id")
    assert "BroadcastHashJoin" in plan(joined)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        text = plan(star.lookup_id(facts, F.col("k"), dim, F.col("name"), "dim_id"))
        assert "SortMergeJoin" in text and "Broadcast" not in text
        assert "Broadcast" not in plan(fill.fill_from_same_key(facts, "id", "k", "id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_frequent_key_of_a_large_lookup_is_split(spark):
    """With no broadcast, adaptive execution cuts the partition of a key that holds a third of the rows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    facts = stage(spark.range(0, 300000, 1, 16).selectExpr(
        "id", "if(id % 3 = 0, 'hot', cast(id % 5000 as string)) as k", "uuid() as payload"
    ))
    dim = stage(spark.range(5000).selectExpr("if(id = 0, 'hot', cast(id as string)) as name", "id as dim_id"))
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = star.lookup_id(facts, F.col("k"), dim, F.col("name"), "dim_id")
        joined.write.format("noop").mode("overwrite").save()
        rows = joined.collect()
        assert "skew=true" in plan(joined) and len(rows) == 300000
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_top_k_does_not_sort_everything(spark, small):
    star_tables = warehouse.build_star(dirty(spark, small, "orders_raw", order="ord"))
    assert "TakeOrderedAndProject" in plan(reports.top_customer(star_tables))


def test_reports_sum_before_they_join(spark, small):
    star_tables = warehouse.build_star(dirty(spark, small, "orders_raw", order="ord"))
    text = plan(reports.sales_by_product(star_tables))
    assert "partial_sum(amount" in text
    join = min(i for i in (text.find("HashJoin [product_id"), text.find("SortMergeJoin [product_id")) if i > 0)
    assert join < text.rindex("partial_sum(amount")


def test_cells_of_fingerprints_are_not_broadcast(spark):
    """Each value enters some 48 cells, which the size that the planner goes by does not show."""
    values = spark.range(3000).select(F.xxhash64("id").alias("fp"))
    near = values.select(F.col("fp").bitwiseXOR(F.lit(5).cast("long")).alias("fp"))  # two bits
    prints = stage(values.union(near))
    pairs = simhash.linked(prints)
    found = {tuple(row) for row in pairs.collect()}
    assert found == {(min(v, v ^ 5), max(v, v ^ 5)) for (v,) in values.collect()}
    assert "SortMergeJoin" in plan(pairs) and "Broadcast" not in plan(pairs)
