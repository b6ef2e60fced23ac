"""Whole jobs: invariants, loading, and independence from partitioning."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starwash.operators import checks
from starwash.plans import order_quality as quality, order_warehouse as warehouse, reports, retail_sales as retail
from starwash.sources.csv import scan_csv
from starwash.workload.views import dirty


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def raw(spark, small):
    return dirty(spark, small, "orders_raw", order="ord")


@pytest.fixture(scope="module")
def star(raw):
    return warehouse.build_star(raw)


@pytest.fixture(scope="module")
def loadable(star):
    """The star without the orders whose price could not be read: a fact holds no null."""
    return {**star, "fact_sales": star["fact_sales"].dropna(subset=warehouse.FACT)}


@pytest.fixture(scope="module")
def ecom(spark, small):
    return dirty(spark, small, "ecom", copies=True)


@pytest.fixture(scope="module")
def cleaned(ecom):
    return quality.clean(ecom).cache()


def test_every_raw_order_is_accounted_for(raw, star):
    typed = warehouse.standardize(raw)
    usable = typed.dropna(subset=warehouse.CORE)
    copies = usable.count() - usable.select("order_id").distinct().count()
    assert star["fact_sales"].count() + copies + (typed.count() - usable.count()) == raw.count()


def test_star_meets_its_constraints(loadable):
    star = loadable
    fact = star["fact_sales"]
    checks.require_foreign_keys(fact, {k: star[t] for k, t in warehouse.FOREIGN_KEYS.items()})
    checks.require_unique(fact, "order_id")
    checks.require_not_null(fact, warehouse.FACT)
    for table, key in (("dim_customer", "customer_id"), ("dim_product", "product_id"), ("dim_date", "date_id")):
        n = star[table].count()
        assert star[table].agg(F.min(key), F.max(key), F.countDistinct(key)).first() == (1, n, n)


def test_reports_agree_with_each_other(star):
    out = {n: df.collect() for n, df in reports.run_all(star).items()}
    total = out["total_sales"][0].total_sales
    for name in ("sales_by_product", "sales_by_month"):
        assert sum(r.total_sales for r in out[name]) == pytest.approx(total)
    assert [r.table_name for r in out["table_row_counts"]] == reports.TABLES
    sales = [r.total_sales for r in out["top_customer"]]
    assert len(sales) == 10 and sales == sorted(sales, reverse=True)


def test_result_does_not_depend_on_partitioning(raw, star):
    again = warehouse.build_star(raw.repartition(5, "Customer_Name"))
    for name, df in star.items():
        assert bag(df) == bag(again[name]), name


def test_warehouse_load(spark, loadable):
    star = loadable
    spark.sql("CREATE DATABASE IF NOT EXISTS wh")
    counts = warehouse.load_star(spark, star, "wh")
    assert counts == {r.table_name: r.row_count for r in reports.table_row_counts(star).collect()}
    assert warehouse.load_star(spark, star, "wh") == counts  # a second run starts fresh
    stored = {t: spark.table(f"wh.{t}") for t in star}
    assert bag(reports.sales_by_product(stored)) == bag(reports.sales_by_product(star))


def test_a_failed_load_leaves_the_old_warehouse(spark, loadable):
    spark.sql("CREATE DATABASE IF NOT EXISTS wh3")
    before = warehouse.load_star(spark, loadable, "wh3")
    customers = loadable["dim_customer"]
    first = F.col("customer_id") == 1
    broken = [
        {"dim_customer": customers.withColumn("customer_name", F.when(~first, F.col("customer_name")))},
        {"dim_customer": customers.withColumn("email", F.lit("one@example.com"))},
        {"fact_sales": loadable["fact_sales"].unionAll(loadable["fact_sales"])},
        {"fact_sales": loadable["fact_sales"].withColumn("date_id", F.lit(-1).cast("bigint"))},
    ]
    for tables in broken:
        with pytest.raises(checks.ValidationError):
            warehouse.load_star(spark, {**loadable, **tables}, "wh3")
    assert {t: spark.table(f"wh3.{t}").count() for t in before} == before


def test_date_filters_skip_files_of_the_fact(spark, loadable):
    spark.sql("CREATE DATABASE IF NOT EXISTS wh4")
    warehouse.load_star(spark, loadable, "wh4")
    per_file = spark.table("wh4.fact_sales").groupBy("_metadata.file_path").agg(F.min("date_id").alias("a"), F.max("date_id").alias("b"))
    ranges = sorted((r.a, r.b) for r in per_file.collect())
    assert len(ranges) > 1 and all(x[1] <= y[0] for x, y in zip(ranges, ranges[1:]))


def test_retail_load_refuses_repeated_sales(spark, small, tmp_path):
    star = retail.build_star(dirty(spark, small, "sales", order="ord"))
    retail.write_star(star, str(tmp_path))
    old = spark.read.parquet(str(tmp_path / "Fact_Sales")).count()
    for fact in (
        star["Fact_Sales"].unionAll(star["Fact_Sales"]),
        star["Fact_Sales"].withColumn("Product_ID", F.lit(-1).cast("bigint")),
    ):
        with pytest.raises(checks.ValidationError):
            retail.write_star({**star, "Fact_Sales": fact}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "Fact_Sales")).count() == old


def test_fractional_quantities(spark, small):
    star = retail.build_star(dirty(spark, small, "sales", order="ord"))
    assert not star["Fact_Sales"].filter("Quantity = 2.5").isEmpty()


def test_sorted_reports_are_sorted(star):
    products = [(-r.total_sales, r.product_name) for r in reports.sales_by_product(star).collect()]
    months = [(r.year, r.month) for r in reports.sales_by_month(star).collect()]
    assert [p[0] for p in products] == sorted(p[0] for p in products) and months == sorted(months)


def test_accuracy_uses_the_exact_product(spark):
    rows = [("a", 1, 100.004, 0.0, 101.002, "N"), ("b", 1, 100.0, 0.0, 101.001, None), ("c", 1, 100.0, 0.0, 250.0, "Y")]
    df = spark.createDataFrame(
        rows, "id string, Quantity int, Unit_Price double, Discount_Rate double, Transaction_Amount double, Is_Promotion string"
    ).withColumn("Order_Status", F.lit("Completed"))
    got = {r.id: r.Accuracy_Flag for r in quality.check_validity(df).collect()}
    assert got == {"a": False, "b": True, "c": False}


def test_broken_facts_are_not_loaded(spark, loadable):
    star = loadable
    spark.sql("CREATE DATABASE IF NOT EXISTS wh2")
    warehouse.create_tables(spark, "wh2")
    warehouse.load_dimensions({n: d for n, d in star.items() if n != "fact_sales"}, "wh2")
    fact = star["fact_sales"]
    orphan = fact.limit(1).withColumn("customer_id", F.lit(-1).cast("bigint"))
    no_price = fact.withColumn("unit_price", F.lit(None).cast("double"))
    for broken in (orphan, fact.unionAll(fact), no_price, fact.filter("false")):
        with pytest.raises(checks.ValidationError):
            warehouse.load_fact(spark, broken, "wh2")
    assert spark.table("wh2.fact_sales").count() == 0
    assert warehouse.load_fact(spark, fact, "wh2") == fact.count()


def test_retail_star(spark, small, tmp_path):
    raw = dirty(spark, small, "sales", order="ord")
    star = retail.build_star(raw)
    fact = star["Fact_Sales"]
    assert fact.filter("Location_ID is null or Product_ID is null or Date_ID is null").isEmpty()
    checks.require_unique(fact, "Sale_ID")
    retail.write_star(star, str(tmp_path))
    retail.write_star(star, str(tmp_path))  # replaces
    assert spark.read.parquet(str(tmp_path / "Fact_Sales")).count() == fact.count()


def test_retail_rejects_and_order_of_steps(spark):
    columns = ["Sale_ID", "Store_Code", "Branch", "Province", "Region", "Product_Name", "Category",
               "Sale_Date", "Quantity", "Unit_Price", "Discount_Percent"]
    tail = ["s1", "b", "p", "r", "x", "y"]
    data = [
        ("1", *tail, "junk", "2", "10", None, 1),
        ("1", *tail, "2024-01-05", "2", "10", "50", 2),
        (" ", *tail, "2024-01-05", "2", "10", None, 3),
        (None, *tail, "2024-01-05", "2", "10", None, 4),
        ("2", "s1", "b", "p", None, "x", "y", "05-Jan-2024", "1", "0.125", None, 5),
    ]
    raw = spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns) + ", ord int")
    assert retail.rejected(raw).count() == 2
    # The unusable first copy of sale 1 takes the good one with it, unless bad rows are dropped first.
    assert bag(retail.clean(raw).select("Sale_ID", "Region", "Total_Amount")) == [("2", "R", 0.12)]
    kept = retail.clean(raw, dedupe_first=False).select("Sale_ID", "Region", "Total_Amount")
    assert bag(kept) == [("1", "R", 10.0), ("2", "R", 0.12)]


def test_quality_chain(ecom, cleaned):
    assert cleaned.count() == ecom.dropDuplicates().count()
    assert cleaned.filter("Customer_Email is null or Province is null").isEmpty()
    promo = cleaned.filter("Is_Promotion = 'Y'")
    assert promo.filter(f"not {quality.AMOUNT} <=> {quality.BEFORE}").isEmpty()
    bounds = quality.bounds_of_regular_sales(ecom.dropDuplicates(), quality.AMOUNT, quality.PROMOTION).first()
    outside = (F.col(quality.AMOUNT) < bounds.lower_bound) | (F.col(quality.AMOUNT) > bounds.upper_bound)
    assert cleaned.filter("not Is_Promotion <=> 'Y'").filter(outside).isEmpty()
    assert cleaned.filter(F.col("Order_Date").rlike(r"^\d{4}-\d{2}-\d{2}$")).count() == cleaned.count()


def test_quality_report_order_and_export(spark, ecom, cleaned, tmp_path):
    report = quality.quality_report(ecom, cleaned)
    got = report.collect()
    assert len(got) == 10 and got[0].metric == "Total rows" and got[9].metric.startswith("Invalid Order_Status")
    assert [r.after_cleaning for r in got[1:4]] == ["0", "0", "0"]
    quality.export(cleaned, report, str(tmp_path))
    exported = scan_csv(spark, str(tmp_path / "e_commerce_clean"))
    assert exported.count() == cleaned.count() and quality.BEFORE not in exported.columns
    assert scan_csv(spark, str(tmp_path / "data_quality_report")).count() == 10


def test_standardising_twice_changes_nothing(cleaned):
    assert bag(quality.standardize_categories(cleaned).select("Transaction_ID", "Gender", "Payment_Method")) == bag(
        cleaned.select("Transaction_ID", "Gender", "Payment_Method")
    )
