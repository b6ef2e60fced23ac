"""Orders to warehouse: customers, products, dates, a validated sales fact with its reject table."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from starwash.functions.dates import date_text, parse_flexible_date
from starwash.functions.numeric import impute_amount, parse_currency, parse_number
from starwash.functions.text import clean_columns, clean_email, normalize_key
from starwash.operators.checks import (
    TableRules, require_foreign_keys, require_not_null, require_rows, require_unique, require_valid,
)
from starwash.operators.dedupe import keep_first
from starwash.operators.fill import is_complete, keep_incomplete
from starwash.operators.star import (
    append_dimension, build_date_dimension, build_dimension, build_filled_dimension, lookup_id, matched_ids, unmatched,
)
from starwash.sources.publish import warehouse_of
from starwash.sources.staging import shuffles_removed, stage, stage_all, stage_alone, staging_scope
from starwash.sources.tables import WAREHOUSE, create_tables, load_dimensions, qualified, read_table, write_table

# What the dimensions promise, checked before anything is replaced.
DIMENSION_RULES = {
    "dim_customer": TableRules(["customer_id", "customer_name", "email"], ["customer_id", "email"]),
    "dim_product": TableRules(["product_id", "product_name", "category"], ["product_id", "product_name"]),
    "dim_date": TableRules(["date_id", "date"], ["date_id", "date"]),
}

CORE = ["order_id", "order_date", "email_key", "product_key", "amount"]
CLEAN = [
    "order_id", "customer_name", "email", "email_key", "product_name", "product_key", "category",
    "order_date", "quantity", "unit_price", "amount",
]
IDS = ["customer_id", "product_id", "date_id"]
FOREIGN_KEYS = {"customer_id": "dim_customer", "product_id": "dim_product", "date_id": "dim_date"}
# Natural key, as SQL over the dimension's columns, and id of each dimension.
NATURAL_KEYS = {
    "dim_customer": ("lower(email)", "customer_id"),
    "dim_product": ("lower(product_name)", "product_id"),
    "dim_date": ("date", "date_id"),
}
FACT = ["order_id", *IDS, "quantity", "unit_price", "amount"]


def standardize(raw: DataFrame, order: str | None = "ord") -> DataFrame:
    """Every raw column cleaned and typed; no row is dropped. Without ``order`` there is no such column."""
    names = {"customer_name": "Customer_Name", "product_name": "Product", "category": "Category"}
    others = {
        "email": clean_email(F.col("Email")),
        "order_date": parse_flexible_date(F.col("Order_Date")),
        "quantity": parse_number(F.col("Quantity")),
        "unit_price": parse_currency(F.col("Unit_Price")),
        "amount": parse_currency(F.col("Amount")),
    }
    typed = clean_columns(raw, {"order_id": "Order_ID"}, names, others, blank_to_null=True)
    keyed = typed.select(
        *[c for c in CLEAN if c not in ("email_key", "product_key", "amount")],
        normalize_key(F.col("email")).alias("email_key"),
        normalize_key(F.col("product_name")).alias("product_key"),
        impute_amount(F.col("amount"), F.col("quantity"), F.col("unit_price")).alias("amount"),
        *([order] if order else []),
    )
    return keyed.select(*CLEAN, *([order] if order else []))


def clean(raw: DataFrame, order: str = "ord") -> DataFrame:
    """Usable rows, the first per order id. Staged: all dimensions and the fact start from it."""
    return clean_standardized(standardize(raw, order), order)


def clean_standardized(typed: DataFrame, order: str = "ord") -> DataFrame:
    """:func:`clean` of rows that :func:`standardize` has cleaned."""
    return stage(first_usable(typed, order))


def first_usable(typed: DataFrame, order: str = "ord") -> DataFrame:
    return keep_first(typed, "order_id", order, usable=is_complete(typed, CORE))


def clean_in_turn(spark: SparkSession, raw: Callable[[], DataFrame], order: str = "ord") -> DataFrame:
    """:func:`clean` of what ``raw`` returns, for jobs that go on to hold much on disk.

    The standardized rows are staged before the first of each order are chosen, so that the shuffles below and above
    never lie on disk at the same time, and what is staged on the way, by ``raw`` too, goes when it has been read.
    """

    def typed() -> DataFrame:
        return stage_alone(spark, lambda: standardize(raw(), order))

    return stage_alone(spark, lambda: first_usable(typed(), order))


def rejected(raw: DataFrame, order: str | None = "ord") -> DataFrame:
    """Rows that cleaning drops because a core column is missing even after imputation."""
    return keep_incomplete(standardize(raw, order), CORE)


def dim_customer(orders: DataFrame, order: str = "ord") -> DataFrame:
    columns = ["email_key", "customer_name", "email"]
    return build_dimension(orders, columns, "email_key", "customer_id", order).drop("email_key")


def dim_product(orders: DataFrame, order: str = "ord") -> DataFrame:
    return build_filled_dimension(
        orders, "product_key", "product_name", "category", "Uncategorized", "product_id", order
    )


def dim_date(orders: DataFrame) -> DataFrame:
    return build_date_dimension(orders, "order_date")


def build_dimensions(orders: DataFrame, order: str = "ord") -> dict[str, DataFrame]:
    """All dimensions, staged, so that the fact joins tables of known size."""
    return stage_all({
        "dim_customer": lambda: dim_customer(orders, order),
        "dim_product": lambda: dim_product(orders, order),
        "dim_date": lambda: dim_date(orders),
    })


def with_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return lookup_id(orders, F.col("email_key"), customers, F.lower("email"), "customer_id")


def with_product(orders: DataFrame, products: DataFrame) -> DataFrame:
    return lookup_id(orders, F.col("product_key"), products, F.lower("product_name"), "product_id")


def with_date(orders: DataFrame, dates: DataFrame) -> DataFrame:
    return lookup_id(orders, date_text(F.col("order_date")), dates, F.col("date"), "date_id")


def with_ids(orders: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    keyed = with_customer(orders, dimensions["dim_customer"])
    keyed = with_product(keyed, dimensions["dim_product"])
    return with_date(keyed, dimensions["dim_date"])


def fact_projection(keyed: DataFrame) -> DataFrame:
    """Ids and measures only, typed; a fractional quantity is cut off, ``cut_quantities`` counts how many."""
    whole = [*IDS, "quantity"]
    return keyed.select(*[F.col(c).cast("bigint").alias(c) if c in whole else F.col(c) for c in FACT])


def cut_quantities(orders: DataFrame) -> DataFrame:
    """``(n_rows, n_cut)``: rows with a quantity, and those whose quantity the fact cannot hold as it is."""
    quantity = F.col("quantity")
    return orders.agg(F.count("quantity").alias("n_rows"), F.count_if(quantity != F.floor(quantity)).alias("n_cut"))


def fact_sales(orders: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    keyed = with_ids(orders, dimensions)
    return fact_projection(keyed.filter(~unmatched(keyed, IDS)))


def fact_unmatched(orders: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Rows the fact leaves out because an id is missing."""
    keyed = with_ids(orders, dimensions)
    return keyed.filter(unmatched(keyed, IDS)).select("order_id", *IDS)


def build_star(raw: DataFrame, order: str = "ord") -> dict[str, DataFrame]:
    orders = clean(raw, order)
    dimensions = build_dimensions(orders, order)
    return {**dimensions, "fact_sales": fact_sales(orders, dimensions)}


def require_fact(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> None:
    """Foreign keys, unique ids, required columns, not empty; raises on a broken one."""
    require_foreign_keys(fact, {key: dimensions[name] for key, name in FOREIGN_KEYS.items()})
    require_unique(fact, "order_id")
    require_not_null(fact, FACT)
    require_rows(fact)


def load_fact(spark: SparkSession, fact: DataFrame, database: str | None = None, checked: bool = False) -> int:
    """Append the fact after its checks, sorted into ranges of the date so that date filters skip files."""
    if not checked:
        require_fact(fact, {name: read_table(spark, name, database) for name in FOREIGN_KEYS.values()})
    return write_table(fact, f"{database}.fact_sales" if database else "fact_sales", cluster_by="date_id")


def check_star(tables: Mapping[str, DataFrame]) -> None:
    """Every constraint of the warehouse; raises on a broken one."""
    require_valid(tables, DIMENSION_RULES)
    require_fact(tables["fact_sales"], tables)


def load_star(spark: SparkSession, star: Mapping[str, DataFrame], database: str | None = None) -> dict[str, int]:
    """Fresh load of the whole warehouse: rows per table.

    A new version of all tables is written and checked, then published by one rename. A load that fails or is
    stopped at any point leaves the old warehouse or, from the rename on, the new one; the next load, or
    ``Warehouse.recover``, points the rest of the catalog tables to it.
    """
    with shuffles_removed(spark):
        return warehouse_of(spark, database).publish(
            {name: star[name] for name in WAREHOUSE}, check_star, WAREHOUSE, {"fact_sales": "date_id"}
        )


def append_star(spark: SparkSession, star: Mapping[str, DataFrame], database: str | None = None) -> dict[str, int]:
    """Add another load to the warehouse: rows added per table.

    ``star`` has ids of its own. Its dimension rows that the warehouse does not have are appended with ids above the
    stored ones, then the facts of orders that it does not have, with the stored ids. Every step adds only what is
    missing, so a load that was stopped is completed by running it again, and a second run adds nothing. What it stages
    on the way goes when it ends.
    """
    added = {}
    with shuffles_removed(spark), staging_scope(spark):
        for name, (key, id_column) in NATURAL_KEYS.items():
            added[name] = append_dimension(
                read_table(spark, name, database), star[name], F.expr(key), id_column,
                lambda rows, n=name: write_table(rows, qualified(n, database)),
            )
        fact = star["fact_sales"]
        for name, (key, id_column) in NATURAL_KEYS.items():
            ids = matched_ids(star[name], read_table(spark, name, database), F.expr(key), id_column)
            fact = fact.join(ids, id_column, "left").withColumn(id_column, F.col("_stored")).drop("_stored")
        known = read_table(spark, "fact_sales", database).select("order_id")
        fresh = stage(fact.select(*FACT).join(known, "order_id", "left_anti"))
        added["fact_sales"] = 0 if fresh.isEmpty() else load_fact(spark, fresh, database)
    return added
