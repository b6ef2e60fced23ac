"""Sales reports over the order star schema (``{table name: DataFrame}``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

Star = Mapping[str, DataFrame]
TABLES = ["dim_customer", "dim_product", "dim_date", "fact_sales"]


def _total(c: str) -> Column:
    return F.round(F.sum(c), 2)


def _per_id(star: Star, id_column: str) -> DataFrame:
    """The fact summed per dimension id, before the dimension is joined."""
    return star["fact_sales"].groupBy(id_column).agg(
        F.sum("amount").alias("amount"), F.sum("quantity").alias("quantity")
    )


def table_row_counts(star: Star, tables: Sequence[str] = TABLES) -> DataFrame:
    counts = [
        star[t].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
        for t in tables
    ]
    return reduce(DataFrame.unionByName, counts)


def total_sales(star: Star) -> DataFrame:
    return star["fact_sales"].agg(
        _total("amount").alias("total_sales"),
        F.sum("quantity").alias("total_quantity"),
        F.count(F.lit(1)).alias("total_orders"),
    )


def sales_by_product(star: Star) -> DataFrame:
    return (
        _per_id(star, "product_id").join(star["dim_product"], "product_id")
        .groupBy("product_name", "category")
        .agg(F.sum("quantity").alias("total_quantity"), _total("amount").alias("total_sales"))
        .orderBy(F.desc("total_sales"), "product_name")
    )


def sales_by_month(star: Star) -> DataFrame:
    return (
        _per_id(star, "date_id").join(star["dim_date"], "date_id")
        .groupBy("year", "month", "month_name").agg(_total("amount").alias("total_sales"))
        .orderBy("year", "month")
    )


def top_customer(star: Star, n: int = 10) -> DataFrame:
    return (
        _per_id(star, "customer_id").join(star["dim_customer"], "customer_id")
        .groupBy("customer_name", "email").agg(_total("amount").alias("total_sales"))
        .orderBy(F.desc("total_sales"), "customer_name", "email").limit(n)
    )


def top_product(star: Star, n: int = 10) -> DataFrame:
    return (
        _per_id(star, "product_id").join(star["dim_product"], "product_id")
        .groupBy("product_name").agg(_total("amount").alias("total_sales"))
        .orderBy(F.desc("total_sales"), "product_name").limit(n)
    )


REPORTS = {
    "table_row_counts": table_row_counts,
    "total_sales": total_sales,
    "sales_by_product": sales_by_product,
    "sales_by_month": sales_by_month,
    "top_customer": top_customer,
    "top_product": top_product,
}


def run_all(star: Star) -> dict[str, DataFrame]:
    """All reports by name, lazy."""
    return {name: report(star) for name, report in REPORTS.items()}
