"""Every operator and job as a query over the driver tables: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from starwash.functions import dates, numeric, rules, text
from starwash.operators import checks, dedupe, fill, ordering, outliers, profile, quantiles, star
from starwash.plans import order_quality as quality, order_warehouse as warehouse, reports, retail_sales as retail
from starwash.sources.csv import REJECT, scan_csv, split_rejects, write_csv
from starwash.sources.publish import warehouse_of
from starwash.sources.staging import shuffles_removed, stage, staged_path, staging_scope
from starwash.sources.tables import write_table
from starwash.workload.views import columns_of, dirty

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ORD = "ord"
PROFILED = ["Gender", "Payment_Method", "Order_Status", "Is_Promotion", "Province"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _sales(spark: SparkSession, sf: str, *columns: str, order: bool = False) -> DataFrame:
    return dirty(spark, sf, "sales", columns, ORD if order else None)


def _raw_orders(spark: SparkSession, sf: str, *columns: str, order: bool = False) -> DataFrame:
    return dirty(spark, sf, "orders_raw", columns, ORD if order else None)


def _ecom(spark: SparkSession, sf: str, *columns: str, copies: bool = True) -> DataFrame:
    return dirty(spark, sf, "ecom", columns, copies=copies)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- reading -----------------------------------------------------------------------------------


@query
def scan_all_text(spark, sf):
    """The raw sales written as CSV and scanned back, all columns as text."""
    path = staged_path(spark)
    write_csv(_sales(spark, sf), path)
    return scan_csv(spark, path, columns_of("sales"))


@query
def scan_typed(spark, sf):
    """Sales written as CSV and scanned with types."""
    names = ["Transaction_ID", "Quantity", "Transaction_Amount", "Unit_Price"]
    path = staged_path(spark)
    write_csv(_ecom(spark, sf, *names, copies=False), path)
    types = {"Quantity": "bigint", "Transaction_Amount": "double", "Unit_Price": "double"}
    return scan_csv(spark, path, names, types=types)


@query
def csv_rejects(spark, sf):
    """Orders written as CSV lines, every seventh key with one field too many; the malformed ones by last digit."""
    path = staged_path(spark)
    line = F.concat_ws(",", F.col("o_orderkey"), F.col("o_custkey"), F.when(F.col("o_orderkey") % 7 == 0, "extra"))
    _table(spark, sf, "orders").select(line.alias("value")).write.text(path)
    scanned = scan_csv(spark, path, ["key", "customer"], rejects=REJECT, header=False)
    _, bad = split_rejects(scanned)
    key = F.substring_index(REJECT, ",", 1).cast("bigint")
    return bad.groupBy((key % 10).alias("last_digit")).agg(F.count(F.lit(1)).alias("n_bad"))


@query
def scan_stray_quotes(spark, sf):
    """Orders written as lines: a quote inside a plain field, a quoted field with a comma and quotes, a plain one."""
    path, third = staged_path(spark), F.col("o_orderkey") % 3
    text_of = F.when(third == 0, 'pipe 5" wide').when(third == 1, '"a ""b"", c"').otherwise(F.col("o_orderpriority"))
    line = F.concat_ws(",", F.col("o_orderkey"), text_of, F.col("o_custkey"))
    _table(spark, sf, "orders").select(line.alias("value")).write.text(path)
    return scan_csv(spark, path, ["key", "name", "customer"], header=False)


@query
def scan_in_order(spark, sf):
    """Lines of several files with an ordinal, which no two share."""
    path = staged_path(spark)
    nations = _table(spark, sf, "nation").select(F.concat_ws(",", "n_nationkey", "n_name").alias("value"))
    nations.repartition(3, "value").write.text(path)
    rows = scan_csv(spark, path, ["key", "name"], order_column=ORD, header=False)
    return rows.select("key", "name", (F.count(ORD).over(W.partitionBy(ORD)) == 1).alias("alone"))


@query
def clean_orders_from_csv(spark, sf):
    """The whole quality chain, from CSV."""
    path = staged_path(spark)
    write_csv(_ecom(spark, sf), path)
    numbers = {c: "double" for c in ("Transaction_Amount", "Unit_Price", "Discount_Rate")}
    raw = scan_csv(spark, path, columns_of("ecom"), types={**numbers, "Quantity": "bigint"})
    cleaned = quality.clean(raw).withColumn(quality.AMOUNT, F.round(quality.AMOUNT, 4))
    return cleaned.select(
        "Transaction_ID", "Customer_Email", "Order_Date", "Order_Date_Parse_Method", "Quantity", quality.AMOUNT,
        "Accuracy_Flag", "Is_Late_Load",
    )


@query
def preview(spark, sf):
    lines = _table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    first = profile.preview(lines.withColumn(ORD, order), ORD)
    return first.select("l_orderkey", "l_linenumber", "l_quantity")


@query
def null_tokens(spark, sf):
    raw = _sales(spark, sf, "Sale_ID", "Region", "Quantity", "Unit_Price", "Discount_Percent")
    return text.null_tokens_to_null(raw)


# --- scalar functions --------------------------------------------------------------------------


@query
def clean_text(spark, sf):
    raw = _sales(spark, sf, "Sale_ID", "Store_Code", *retail.TITLE_COLUMNS)
    return retail.standardize_text(raw)


@query
def parse_number(spark, sf):
    raw = _sales(spark, sf, "Sale_ID", "Quantity", "Unit_Price", "Discount_Percent")
    return raw.select(
        "Sale_ID",
        numeric.parse_number(F.col("Quantity")).alias("Quantity"),
        numeric.parse_number(F.col("Unit_Price")).alias("Unit_Price"),
        F.coalesce(numeric.parse_number(F.col("Discount_Percent")), F.lit(0.0)).alias("Discount_Percent"),
    )


@query
def parse_currency(spark, sf):
    raw = _raw_orders(spark, sf, "Order_ID", "Unit_Price", "Amount")
    return raw.select(
        "Order_ID",
        numeric.parse_currency(F.col("Unit_Price")).alias("unit_price"),
        numeric.parse_currency(F.col("Amount")).alias("amount"),
    )


@query
def parse_dates_multi(spark, sf):
    raw = _sales(spark, sf, "Sale_ID", "Sale_Date")
    return raw.select(
        "Sale_ID",
        dates.parse_dates(F.col("Sale_Date")).alias("three_formats"),
        dates.parse_flexible_date(F.col("Sale_Date")).alias("flexible"),
    )


@query
def parse_dates_ambiguous(spark, sf):
    raw = _ecom(spark, sf, "Transaction_ID", "Order_Date", "Load_Timestamp", copies=False)
    return quality.resolve_order_dates(raw).drop("Load_Timestamp")


@query
def net_amount(spark, sf):
    raw = _sales(spark, sf, "Sale_ID", "Quantity", "Unit_Price", "Discount_Percent")
    number = {c: numeric.parse_number(F.col(c)) for c in ("Quantity", "Unit_Price", "Discount_Percent")}
    return raw.select(
        "Sale_ID",
        numeric.net_amount(
            number["Quantity"], number["Unit_Price"], F.coalesce(number["Discount_Percent"], F.lit(0.0))
        ).alias("Total_Amount"),
    )


@query
def impute_amount(spark, sf):
    raw = _raw_orders(spark, sf, "Order_ID", "Quantity", "Unit_Price", "Amount")
    amount = numeric.impute_amount(
        numeric.parse_currency(F.col("Amount")),
        numeric.parse_number(F.col("Quantity")),
        numeric.parse_currency(F.col("Unit_Price")),
    )
    return raw.select("Order_ID", amount.alias("amount"))


@query
def helper_clean_text(spark, sf):
    return _raw_orders(spark, sf, "Order_ID").select(text.clean_text(F.col("Order_ID")).alias("order_id"))


@query
def helper_title_case(spark, sf):
    raw = _raw_orders(spark, sf, "Customer_Name", "Product", "Category")
    names = {"customer_name": "Customer_Name", "product_name": "Product", "category": "Category"}
    cleaned = text.clean_text_columns(
        raw.withColumnsRenamed({"Category": "Category_raw"}),
        {**names, "category": "Category_raw"}, title=True, blank_to_null=True,
    )
    return cleaned.select(*names)


@query
def helper_clean_email(spark, sf):
    raw = _raw_orders(spark, sf, "Order_ID", "Email")
    return raw.select("Order_ID", text.clean_email(F.col("Email")).alias("email"))


@query
def helper_normalize_key(spark, sf):
    raw = _raw_orders(spark, sf, "Order_ID", "Email", "Product")
    return raw.select(
        "Order_ID",
        text.normalize_key(text.clean_email(F.col("Email"))).alias("email_key"),
        text.normalize_key(text.title_case_text(F.col("Product"))).alias("product_key"),
    )


@query
def load_delay(spark, sf):
    raw = _ecom(spark, sf, "Transaction_ID", "Order_Date", "Load_Timestamp", copies=False)
    timed = quality.measure_load_delay(quality.resolve_order_dates(raw))
    return timed.select(
        "Transaction_ID", numeric.round_half_even(F.col("Load_Delay_Hours"), 6).alias("Load_Delay_Hours"),
        "Is_Late_Load",
    )


@query
def late_summary(spark, sf):
    raw = _ecom(spark, sf, "Transaction_ID", "Order_Date", "Load_Timestamp")
    return quality.late_summary(quality.measure_load_delay(quality.resolve_order_dates(raw)))


@query
def delay_stats(spark, sf):
    raw = _ecom(spark, sf, "Transaction_ID", "Order_Date", "Load_Timestamp")
    timed = quality.measure_load_delay(quality.resolve_order_dates(raw))
    return _rounded(profile.describe_numbers(timed, ["Load_Delay_Hours"]))


def _rounded(described: DataFrame, digits: int = 4) -> DataFrame:
    """Statistics cut to a few digits: sums of doubles depend on their order in the last ones."""
    return described.withColumns({
        c: F.round(c, digits) for c in ("mean", "std", "min", "q1", "median", "q3", "max")
    })


# --- flags, fills and rules --------------------------------------------------------------------


@query
def missing_flags(spark, sf):
    raw = _ecom(spark, sf, "Transaction_ID", "Customer_ID", "Customer_Email", "Province")
    return quality.complete(raw)


@query
def fill_email(spark, sf):
    raw = _ecom(spark, sf, "Transaction_ID", "Customer_ID", "Customer_Email")
    email = rules.placeholder_email(F.col("Customer_Email"), F.col("Customer_ID"))
    return raw.select("Transaction_ID", email.alias("Customer_Email"))


@query
def fill_constants(spark, sf):
    sales = _sales(spark, sf, "Sale_ID", "Category")
    return fill.fill_constant(sales, {"Category": "Uncategorized"})


@query
def standardize_gender(spark, sf):
    raw = _ecom(spark, sf, "Transaction_ID", "Gender")
    return raw.withColumn("Gender", rules.standardize(F.col("Gender"), rules.GENDER_RULES))


@query
def standardize_payment(spark, sf):
    raw = _ecom(spark, sf, "Transaction_ID", "Payment_Method")
    return raw.withColumn("Payment_Method", rules.standardize(F.col("Payment_Method"), rules.PAYMENT_RULES))


@query
def standardize_status(spark, sf):
    raw = _ecom(spark, sf, "Transaction_ID", "Order_Status")
    return raw.select(
        "Transaction_ID",
        rules.standardize(F.col("Order_Status"), rules.STATUS_RULES).alias("Order_Status"),
        rules.not_in_set(F.col("Order_Status"), rules.ORDER_STATUSES).alias("Order_Status_Was_Invalid"),
    )


@query
def validity_in_set(spark, sf):
    raw = _ecom(spark, sf, "Transaction_ID", "Gender", "Is_Promotion")
    return raw.select(
        "Transaction_ID",
        rules.in_set(F.col("Gender"), ["M", "male"]).alias("gender_in_set"),
        rules.not_in_set(F.col("Is_Promotion"), ["Y", "N"]).alias("promotion_invalid"),
    )


@query
def non_promo_filter(spark, sf):
    raw = _ecom(spark, sf, "Transaction_ID", "Is_Promotion", "Transaction_Amount")
    return raw.filter(rules.differs_from(F.col("Is_Promotion"), "Y"))


@query
def quantity_validity(spark, sf):
    raw = _ecom(spark, sf, "Transaction_ID", "Quantity")
    return raw.withColumn("Quantity_Was_Invalid", rules.invalid_quantity(F.col("Quantity")))


@query
def accuracy_flag(spark, sf):
    raw = _ecom(
        spark, sf, "Transaction_ID", "Quantity", "Unit_Price", "Discount_Rate", "Transaction_Amount",
        "Is_Promotion", "Order_Status",
    )
    return quality.check_validity(raw).select("Transaction_ID", "Expected_Amount", "Accuracy_Flag")


@query
def drop_incomplete(spark, sf):
    typed = retail.standardize(_sales(spark, sf))
    return fill.drop_incomplete(typed, retail.CORE).select("Sale_ID", *retail.CORE)


@query
def fill_region(spark, sf):
    raw = _sales(spark, sf, "Sale_ID", "Store_Code", *retail.TITLE_COLUMNS, order=True)
    sales = retail.standardize_text(raw).select("Sale_ID", "Store_Code", "Region", ORD)
    return fill.fill_from_same_key(sales, "Store_Code", "Region", ORD).drop(ORD)


@query
def group_ffill_bfill(spark, sf):
    raw = dirty(spark, sf, "sales", ["Sale_ID", "Product_Name", "Category"], ORD, keep=["l_partkey"])
    keyed = raw.withColumn("product_key", text.normalize_key(text.strip(F.col("Product_Name"))))
    filled = ordering.fill_within_group(keyed, "product_key", "Category", ORD)
    return filled.select("Sale_ID", "product_key", "Category", "l_partkey")


@query
def expectations(spark, sf):
    return checks.check_expectations(quality.clean(_ecom(spark, sf)), quality.expectations())


@query
def expectation_rejects(spark, sf):
    """Orders that break a rule, with all rules they break."""
    found = checks.quarantine(quality.clean(_ecom(spark, sf)), quality.expectations())
    return found.rejected.select("Transaction_ID", F.array_join("reasons", ";").alias("reasons"))


@query
def expectation_counts(spark, sf):
    """The counts of all rules from the masks of the rows, beside how many rows meet all of them."""
    found = checks.quarantine(quality.clean(_ecom(spark, sf)), quality.expectations())
    accepted = F.lit(found.accepted.count()).cast("bigint")
    return found.counts.withColumn("n_accepted", accepted)


# --- profiling ---------------------------------------------------------------------------------


@query
def profile_schema(spark, sf):
    return profile.schema_profile(_ecom(spark, sf))


@query
def profile_missing(spark, sf):
    return profile.missing_profile(_ecom(spark, sf))


@query
def profile_duplicates(spark, sf):
    return dedupe.duplicate_row_count(_ecom(spark, sf))


@query
def profile_distinct(spark, sf):
    return profile.distinct_counts(_ecom(spark, sf, *PROFILED), PROFILED)


@query
def profile_values(spark, sf):
    return profile.distinct_values(_ecom(spark, sf, *PROFILED), PROFILED)


@query
def profile_describe(spark, sf):
    return _rounded(profile.describe_all(_ecom(spark, sf)))


@query
def extract_report(spark, sf):
    """Schema, missing values, distinct values and copies of the raw table, all of one report."""
    report = profile.extract_report(_ecom(spark, sf))
    copies = F.lit(report["duplicates"].first().duplicate_rows).cast("bigint")
    return (
        report["schema"].join(report["missing"], "column", "left").join(report["distinct"], "column")
        .join(report["describe"].select("column", "top", "freq"), "column")
        .select(
            "column", "dtype", "n_rows", "non_null_count", F.coalesce("missing_count", F.lit(0)).alias("missing_count"),
            "n_distinct", "top", "freq", copies.alias("duplicate_rows"),
        )
    )


@query
def value_counts(spark, sf):
    return profile.value_counts(_ecom(spark, sf, "Gender"), "Gender")


# --- duplicates --------------------------------------------------------------------------------


@query
def dedupe_keep_first(spark, sf):
    raw = _sales(spark, sf, "Sale_ID", "Sale_Date", "Quantity", "Discount_Percent", order=True)
    return dedupe.keep_first(raw, "Sale_ID", ORD).drop(ORD)


@query
def dedupe_exact(spark, sf):
    return dedupe.drop_exact_duplicates(_ecom(spark, sf))


@query
def dup_key_count(spark, sf):
    return dedupe.duplicate_key_count(_sales(spark, sf, "Sale_ID"), "Sale_ID")


@query
def repeated_sales(spark, sf):
    """All copies of sale ids that occur more than once."""
    return dedupe.rows_with_repeated_key(_sales(spark, sf, "Sale_ID", "Sale_Date", "Quantity"), "Sale_ID")


@query
def near_dup_customers(spark, sf):
    raw = _ecom(spark, sf, "Customer_ID", "Customer_Name", "Customer_Email", "Province")
    return dedupe.near_duplicate_customers(
        quality.complete(raw), "Customer_Email", "Customer_Name",
        ["Customer_ID", "Customer_Name", "Customer_Email"], "Customer_Email_Was_Missing",
    )


# --- outliers ----------------------------------------------------------------------------------


def _amounts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    raw = _ecom(spark, sf, "Transaction_ID", "Is_Promotion", "Transaction_Amount")
    return raw, stage(outliers.bounds_of_regular_sales(raw, quality.AMOUNT, quality.PROMOTION))


@query
def iqr_bounds(spark, sf):
    _, bounds = _amounts(spark, sf)
    return bounds.select(*[F.round(c, 4).alias(c) for c in bounds.columns])


@query
def outlier_flags(spark, sf):
    raw, bounds = _amounts(spark, sf)
    return outliers.flag_outliers(raw, bounds, quality.AMOUNT, quality.PROMOTION)


@query
def cap_outliers(spark, sf):
    raw, bounds = _amounts(spark, sf)
    capped = outliers.cap_outliers(raw, bounds, quality.AMOUNT, quality.PROMOTION, before=quality.BEFORE)
    return capped.select(
        "Transaction_ID",
        F.round(quality.AMOUNT, 4).alias(quality.AMOUNT),
        F.round(quality.BEFORE, 4).alias(quality.BEFORE),
        outliers.changed(F.col(quality.AMOUNT), F.col(quality.BEFORE)).alias("was_capped"),
    )


@query
def boxplot_stats(spark, sf):
    raw, bounds = _amounts(spark, sf)
    capped = outliers.cap_outliers(raw, bounds, quality.AMOUNT, quality.PROMOTION, before=quality.BEFORE)
    stats = quantiles.boxplot_statistics(capped, [quality.BEFORE, quality.AMOUNT])
    return stats.withColumns({
        c: F.round(c, 4) for c in ("whisker_low", "q1", "median", "q3", "whisker_high")
    })


# --- retail star schema ------------------------------------------------------------------------


def _clean_sales(spark: SparkSession, sf: str) -> DataFrame:
    return retail.clean(_sales(spark, sf, order=True), ORD)


@query
def clean_sales_a(spark, sf):
    return _clean_sales(spark, sf).drop(ORD)


@query
def surrogate_keys(spark, sf):
    """Dense ids over the sale ids themselves, a key as large as the data."""
    ids = _sales(spark, sf, "Sale_ID").select(text.strip(F.col("Sale_ID")).alias("Sale_ID")).distinct()
    return ordering.with_dense_ids(ids, "Sale_ID", "Sale_Key")


@query
def dim_location(spark, sf):
    return retail.dim_location(_clean_sales(spark, sf), ORD)


@query
def dim_product_a(spark, sf):
    return retail.dim_product(_clean_sales(spark, sf), ORD)


@query
def fact_location_product(spark, sf):
    sales = _clean_sales(spark, sf)
    keyed = retail.with_location_and_product(
        sales, stage(retail.dim_location(sales, ORD)), stage(retail.dim_product(sales, ORD))
    )
    return keyed.select("Sale_ID", "Location_ID", "Product_ID")


@query
def fact_date_lookup(spark, sf):
    sales = _clean_sales(spark, sf)
    return retail.with_date(sales, stage(retail.dim_date(sales))).select("Sale_ID", "Date_ID")


@query
def fact_sales_a(spark, sf):
    return retail.build_star(_sales(spark, sf, order=True), ORD)["Fact_Sales"]


# --- order warehouse ---------------------------------------------------------------------------


def _clean_orders(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.clean(_raw_orders(spark, sf, order=True), ORD)


def _star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return warehouse.build_star(_raw_orders(spark, sf, order=True), ORD)


@query
def clean_sales_b(spark, sf):
    return _clean_orders(spark, sf).drop(ORD)


@query
def rejected_orders(spark, sf):
    # Rows are chosen one by one, so they need no order.
    return warehouse.rejected(_raw_orders(spark, sf), None).select(*warehouse.CORE)


@query
def dim_generic(spark, sf):
    """The generic builder with a key of its own: the first order of each category."""
    orders = _clean_orders(spark, sf)
    return star.build_dimension(orders, ["category", "product_name"], "category", "category_id", ORD)


@query
def dim_customer(spark, sf):
    return warehouse.dim_customer(_clean_orders(spark, sf), ORD)


@query
def dim_product_b(spark, sf):
    return warehouse.dim_product(_clean_orders(spark, sf), ORD)


@query
def dim_date(spark, sf):
    return warehouse.dim_date(_clean_orders(spark, sf))


@query
def fact_customer_key(spark, sf):
    orders = _clean_orders(spark, sf)
    customers = stage(warehouse.dim_customer(orders, ORD))
    return warehouse.with_customer(orders, customers).select("order_id", "customer_id")


@query
def fact_product_key(spark, sf):
    orders = _clean_orders(spark, sf)
    products = stage(warehouse.dim_product(orders, ORD))
    return warehouse.with_product(orders, products).select("order_id", "product_id")


@query
def fact_date_key(spark, sf):
    orders = _clean_orders(spark, sf)
    return warehouse.with_date(orders, stage(warehouse.dim_date(orders))).select("order_id", "date_id")


@query
def fact_projection(spark, sf):
    orders = _clean_orders(spark, sf)
    return warehouse.fact_projection(warehouse.with_ids(orders, warehouse.build_dimensions(orders, ORD)))


@query
def fact_sales_b(spark, sf):
    return _star(spark, sf)["fact_sales"]


@query
def fact_unmatched(spark, sf):
    """Orders before incomplete ones are dropped, against the dimensions of the clean ones."""
    typed = stage(warehouse.standardize(_raw_orders(spark, sf, order=True), ORD))  # read twice
    dimensions = warehouse.build_dimensions(warehouse.clean_standardized(typed, ORD), ORD)
    return warehouse.fact_unmatched(typed, dimensions)


# --- constraints -------------------------------------------------------------------------------


@query
def fk_orphans(spark, sf):
    """Line items whose order, part or supplier is not in the current dimension."""
    dimensions = {
        "l_orderkey": _table(spark, sf, "orders").filter("o_orderstatus <> 'F'").withColumnRenamed("o_orderkey", "l_orderkey"),
        "l_partkey": _table(spark, sf, "part").filter("p_size > 5").withColumnRenamed("p_partkey", "l_partkey"),
        "l_suppkey": _table(spark, sf, "supplier").filter("s_acctbal >= 0").withColumnRenamed("s_suppkey", "l_suppkey"),
    }
    return checks.foreign_key_orphans(_table(spark, sf, "lineitem"), dimensions)


@query
def not_null_violations(spark, sf):
    typed = warehouse.standardize(_raw_orders(spark, sf), None)
    return checks.not_null_violations(typed, [*warehouse.CORE, "customer_name", "category", "quantity", "unit_price"])


@query
def unique_violations(spark, sf):
    sales = _sales(spark, sf, "Sale_ID").select(text.strip(F.col("Sale_ID")).alias("Sale_ID"))
    return checks.unique_violations(sales, "Sale_ID")


# --- reports -----------------------------------------------------------------------------------


def _report(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return reports.REPORTS[name](_star(spark, sf))

    return run


QUERIES.update({name: _report(name) for name in reports.REPORTS})


# --- sinks and loaders -------------------------------------------------------------------------


def _database(spark: SparkSession) -> str:
    """A new database with its files under the shared folder."""
    name = f"starwash_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{staged_path(spark)}'")
    return name


def _closed(spark: SparkSession, database: str, result: DataFrame) -> DataFrame:
    """``result`` staged, and the database it came from dropped, so that the catalog is as before."""
    result = stage(result)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return result


@query
def write_replace(spark, sf):
    """Customers replace the nations that a table held before."""
    database = _database(spark)
    name = f"{database}.customers"
    write_table(_table(spark, sf, "nation"), name, mode="overwrite")
    write_table(_table(spark, sf, "customer"), name, mode="overwrite")
    counts = spark.table(name).groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"))
    return _closed(spark, database, counts)


@query
def write_append_counts(spark, sf):
    """What each append reports, beside what the table holds after both."""
    database = _database(spark)
    name = f"{database}.names"
    written = [
        write_table(_table(spark, sf, t).select(F.col(c).alias("name")), name)
        for t, c in (("nation", "n_name"), ("region", "r_name"))
    ]
    total = spark.table(name).agg(F.count(F.lit(1)).alias("total"))
    counts = total.select(F.explode(F.array(*[F.lit(n).cast("bigint") for n in written])).alias("n"), "total")
    return _closed(spark, database, counts)


@query
def load_star_roundtrip(spark, sf):
    """The warehouse loaded as tables under all its constraints, then read back by SQL."""
    name, built = _database(spark), _star(spark, sf)
    # Orders whose price could not be read break a constraint of the fact; the load refuses them.
    fact = stage(built["fact_sales"])
    built["fact_sales"] = fact.dropna(subset=warehouse.FACT)
    loaded = warehouse.load_star(spark, built, name)
    return _closed(spark, name, spark.sql(
        f"select p.category, count(*) as n_rows, sum(quantity) as total_quantity, "
        f"{fact.count() - loaded['fact_sales']}L as n_left_out from {name}.fact_sales "
        f"join {name}.dim_product p using (product_id) group by p.category"
    ))


@query
def publish_roundtrip(spark, sf):
    """What the catalog holds after a first load, one that a check refuses, one stopped before and one after the
    switch, and the recovery of the last."""
    name = _database(spark)
    target = warehouse_of(spark, name)
    nations, regions = _table(spark, sf, "nation"), _table(spark, sf, "region")
    steps = []

    def seen(step: str) -> None:
        held = [spark.table(f"{name}.{t}").select(F.lit(t).alias("table_name")) for t in ("nation", "region")]
        counts = reduce(DataFrame.unionByName, held).groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows"))
        steps.append(stage(counts.select(F.lit(step).alias("step"), "table_name", "n_rows")))

    def refuse(tables) -> None:
        raise checks.ValidationError("refused")

    target.publish({"nation": nations, "region": regions})
    seen("1 loaded")
    try:
        target.publish({"nation": nations.limit(1), "region": regions.limit(1)}, refuse)
    except checks.ValidationError:
        seen("2 refused")
    small = {"nation": nations.filter("n_regionkey < 3"), "region": regions.filter("r_regionkey < 3")}
    written = target.write(small)
    seen("3 written")
    target.switch(written)
    target.recover()
    seen("4 published")
    return _closed(spark, name, reduce(DataFrame.unionByName, steps))


@query
def append_dimensions(spark, sf):
    """The warehouse of the orders of January to June, then those of July to December appended twice."""
    with shuffles_removed(spark):
        orders = warehouse.clean_in_turn(spark, lambda: _raw_orders(spark, sf, order=True), ORD)
        name = _database(spark)
        early = F.month("order_date") <= 6

        def star_of(part: DataFrame) -> dict[str, DataFrame]:
            dimensions = warehouse.build_dimensions(part, ORD)
            fact = warehouse.fact_sales(part, dimensions).dropna(subset=warehouse.FACT)
            return {**dimensions, "fact_sales": stage(fact)}

        later = star_of(orders.filter(~early))
        with staging_scope(spark):
            warehouse.load_star(spark, star_of(orders.filter(early)), name)
        before = {t: stage(spark.table(f"{name}.{t}")) for t in warehouse.WAREHOUSE}
        for _ in range(2):
            warehouse.append_star(spark, later, name)
        out = []
        for t, old in before.items():
            stored, id_column = spark.table(f"{name}.{t}"), spark.table(f"{name}.{t}").columns[0]
            unchanged = old.join(stored, [old[c].eqNullSafe(stored[c]) for c in old.columns], "left_semi").count()
            out.append(stored.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(id_column).alias("n_ids")).select(
                F.lit(t).alias("table_name"), "n_rows", "n_ids", F.lit(unchanged).cast("bigint").alias("n_unchanged")
            ))
        return _closed(spark, name, reduce(DataFrame.unionByName, out))


@query
def export_roundtrip(spark, sf):
    """The cleaned orders and their report exported as CSV, the orders scanned back."""
    raw = _ecom(spark, sf)
    cleaned, path = quality.clean(raw), staged_path(spark)
    quality.export(cleaned, quality.quality_report(raw, cleaned), path)
    names = [c for c in cleaned.columns if c != quality.BEFORE]
    return scan_csv(spark, f"{path}/e_commerce_clean", names).select(
        "Transaction_ID", "Customer_Email", "Province", "Gender", "Payment_Method", "Order_Date", "Order_Status"
    )


@query
def run_all_reports(spark, sf):
    """Rows of every report, all run over one star."""
    counts = [
        report.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("report"), "n_rows")
        for name, report in reports.run_all({n: stage(t) for n, t in _star(spark, sf).items()}).items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def table_row_counts_a(spark, sf):
    return reports.table_row_counts(retail.build_star(_sales(spark, sf, order=True), ORD), list(retail.RULES))


@query
def violations_a(spark, sf):
    built = retail.build_star(_sales(spark, sf, order=True), ORD)
    return checks.table_violations({n: stage(t) for n, t in built.items()}, retail.RULES)


@query
def dim_violations_b(spark, sf):
    return checks.table_violations(_star(spark, sf), warehouse.DIMENSION_RULES)


@query
def cut_quantities(spark, sf):
    return warehouse.cut_quantities(_clean_orders(spark, sf))


@query
def clean_orders_c(spark, sf):
    cleaned = quality.clean(_ecom(spark, sf))
    money = {c: F.round(c, 4) for c in (quality.AMOUNT, quality.BEFORE, "Load_Delay_Hours")}
    return cleaned.withColumns(money).withColumn(
        "Load_Timestamp", F.date_format("Load_Timestamp", "yyyy-MM-dd HH:mm:ss")
    )


@query
def quality_report(spark, sf):
    raw = _ecom(spark, sf)
    return quality.quality_report(raw, quality.clean(raw))
