"""Retail log to star schema: locations, products, dates and a sales fact that keeps unmatched rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starwash.functions.dates import date_text, parse_dates
from starwash.functions.numeric import net_amount, parse_number
from starwash.functions.text import clean_columns, empty_to_null, strip
from starwash.operators.checks import TableRules, ValidationError, foreign_key_orphans, require_valid
from starwash.operators.dedupe import keep_first
from starwash.operators.fill import drop_incomplete, fill_from_same_key, is_complete
from starwash.operators.star import build_date_dimension, build_dimension, lookup_id
from starwash.sources.publish import Warehouse
from starwash.sources.staging import stage, stage_all

TITLE_COLUMNS = ["Branch", "Province", "Region", "Product_Name", "Category"]
CORE = ["Sale_Date", "Quantity", "Unit_Price"]
LOCATION = ["Store_Code", "Branch", "Province", "Region"]

# What the tables promise; a fact row without a dimension row keeps a null id.
RULES = {
    "Dim_Location": TableRules(["Location_ID"], ["Location_ID", "Store_Code"]),
    "Dim_Product": TableRules(["Product_ID"], ["Product_ID", "Product_Name"]),
    "Dim_Date": TableRules(["Date_ID", "Sale_Date"], ["Date_ID", "Sale_Date"]),
    "Fact_Sales": TableRules(["Sale_ID", "Quantity", "Unit_Price", "Total_Amount"], ["Sale_ID"]),
}
FOREIGN_KEYS = {"Location_ID": "Dim_Location", "Product_ID": "Dim_Product", "Date_ID": "Dim_Date"}


def standardize_text(raw: DataFrame, others: Mapping[str, Column] | None = None) -> DataFrame:
    """Ids and names cleaned; ``others`` are further columns, over the raw ones, for the same projection."""
    ids = {"Sale_ID": empty_to_null(strip(F.col("Sale_ID"))), "Store_Code": strip(F.col("Store_Code"))}
    return clean_columns(raw, {}, {c: c for c in TITLE_COLUMNS}, {**ids, **(others or {})})


def standardize(raw: DataFrame) -> DataFrame:
    """Clean text, numbers and dates; no row is dropped."""
    return standardize_text(raw, {
        "Quantity": parse_number(F.col("Quantity")),
        "Unit_Price": parse_number(F.col("Unit_Price")),
        "Discount_Percent": F.coalesce(parse_number(F.col("Discount_Percent")), F.lit(0.0)),
        "Sale_Date": parse_dates(F.col("Sale_Date")),
    })


def rejected(raw: DataFrame) -> DataFrame:
    """Rows without an id: they can be neither deduplicated nor loaded."""
    return raw.filter(empty_to_null(strip(F.col("Sale_ID"))).isNull())


def clean(raw: DataFrame, order: str = "ord", dedupe_first: bool = True) -> DataFrame:
    """Cleaned rows, one per Sale_ID, with Total_Amount.

    ``dedupe_first`` keeps the first copy of an id even if its core fields are unusable, so the id is
    then lost; otherwise the first usable copy survives.
    """
    typed = standardize(raw)
    usable = is_complete(typed, ["Sale_ID"] if dedupe_first else ["Sale_ID", *CORE])
    # Staged: the region lookup, the dimensions and the fact all start from these rows.
    unique = stage(keep_first(typed, "Sale_ID", order, usable))
    located = drop_incomplete(fill_from_same_key(unique, "Store_Code", "Region", order), CORE)
    amount = net_amount(F.col("Quantity"), F.col("Unit_Price"), F.col("Discount_Percent"))
    return located.withColumn("Total_Amount", amount)


def dim_location(sales: DataFrame, order: str = "ord") -> DataFrame:
    return build_dimension(sales, LOCATION, "Store_Code", "Location_ID", order)


def dim_product(sales: DataFrame, order: str = "ord") -> DataFrame:
    return build_dimension(sales, ["Product_Name", "Category"], "Product_Name", "Product_ID", order)


def dim_date(sales: DataFrame) -> DataFrame:
    days = build_date_dimension(sales, "Sale_Date", "Date_ID")
    return days.select(
        "Date_ID",
        F.col("date").alias("Sale_Date"),
        F.col("year").alias("Year"),
        F.col("month").alias("Month"),
        F.col("day").alias("Day"),
        F.col("quarter").alias("Quarter"),
        F.col("weekday_name").alias("Weekday"),
    )


def with_location_and_product(sales: DataFrame, locations: DataFrame, products: DataFrame) -> DataFrame:
    located = lookup_id(sales, F.col("Store_Code"), locations, F.col("Store_Code"), "Location_ID")
    return lookup_id(located, F.col("Product_Name"), products, F.col("Product_Name"), "Product_ID")


def with_date(sales: DataFrame, dates: DataFrame) -> DataFrame:
    return lookup_id(sales, date_text(F.col("Sale_Date")), dates, F.col("Sale_Date"), "Date_ID")


def fact_sales(sales: DataFrame, locations: DataFrame, products: DataFrame, dates: DataFrame) -> DataFrame:
    """Ids and measures; a row without a dimension row stays, with a null id."""
    keyed = with_date(with_location_and_product(sales, locations, products), dates)
    return keyed.select(
        "Sale_ID",
        "Location_ID",
        "Product_ID",
        "Date_ID",
        "Quantity",
        "Unit_Price",
        "Discount_Percent",
        "Total_Amount",
    )


def build_star(raw: DataFrame, order: str = "ord") -> dict[str, DataFrame]:
    sales = clean(raw, order)
    dimensions = stage_all({
        "Dim_Location": lambda: dim_location(sales, order),
        "Dim_Product": lambda: dim_product(sales, order),
        "Dim_Date": lambda: dim_date(sales),
    })
    return {**dimensions, "Fact_Sales": fact_sales(sales, *dimensions.values())}


def unmatched_ids(star: dict[str, DataFrame]) -> DataFrame:
    """Ids of the fact, null apart, that a dimension does not hold; as ``foreign_key_orphans``."""
    held = {key: star[name] for key, name in FOREIGN_KEYS.items()}
    return foreign_key_orphans(star["Fact_Sales"], held).filter("key_value is not null")


def check_star(tables: Mapping[str, DataFrame]) -> None:
    """Every constraint of the star; raises on a broken one."""
    require_valid(tables, RULES)
    if not unmatched_ids(tables).isEmpty():
        raise ValidationError("the fact refers to ids that no dimension has")


def write_star(star: Mapping[str, DataFrame], path: str) -> dict[str, int]:
    """Publish all tables as Parquet folders under ``path``, replacing an earlier run; rows per table.

    They are written as a new version and checked there; a broken constraint raises before anything is replaced.
    One rename makes the version the current one, then its folders are moved to ``<path>/<table>``. ``read_star``
    reads one whole version at any time, also while a stopped run waits to be carried out by the next.
    """
    return Warehouse(next(iter(star.values())).sparkSession, path).publish(star, check_star)


def read_star(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    warehouse = Warehouse(spark, path)
    return {name: warehouse.read(name) for name in RULES}
