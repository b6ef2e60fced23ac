"""Catalog tables of the warehouse: create, drop, load, read back."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession, functions as F

# Column types of the published warehouse, dimensions before the fact.
WAREHOUSE = {
    "dim_customer": "customer_id BIGINT, customer_name STRING, email STRING",
    "dim_product": "product_id BIGINT, product_name STRING, category STRING",
    "dim_date": (
        "date_id BIGINT, date STRING, year BIGINT, quarter BIGINT, month BIGINT, "
        "month_name STRING, day BIGINT, weekday_name STRING"
    ),
    "fact_sales": (
        "order_id STRING, customer_id BIGINT, product_id BIGINT, date_id BIGINT, "
        "quantity BIGINT, unit_price DOUBLE, amount DOUBLE"
    ),
}


def qualified(name: str, database: str | None) -> str:
    return f"{database}.{name}" if database else name


def create_tables(spark: SparkSession, database: str | None = None, fresh: bool = True) -> None:
    """Create the warehouse tables; ``fresh`` drops the old ones first."""
    if fresh:
        drop_tables(spark, database)
    for name, columns in WAREHOUSE.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {qualified(name, database)} ({columns}) USING parquet")


def drop_tables(spark: SparkSession, database: str | None = None) -> None:
    for name in reversed(WAREHOUSE):
        spark.sql(f"DROP TABLE IF EXISTS {qualified(name, database)}")


def counted_write(df: DataFrame, cluster_by: str | None, write: Callable[[DataFrameWriter], None]) -> int:
    """Write and return the row count, counted during the write.

    ``cluster_by`` sorts the rows into ranges of one column, so that readers which filter on it skip
    files and row groups by their min/max statistics. There are as many files as shuffle partitions, since
    adaptive execution would merge a small table's ranges into one.
    """
    if cluster_by:
        files = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(files, cluster_by).sortWithinPartitions(cluster_by)
    written = Observation()
    write(df.observe(written, F.count(F.lit(1)).alias("rows")).write)
    return written.get["rows"]


def write_table(df: DataFrame, name: str, mode: str = "append", cluster_by: str | None = None) -> int:
    """Write a catalog table and return the row count, as ``counted_write``.

    ``overwrite`` drops the old table before it writes: use ``publish.Warehouse`` where a stopped load must not
    leave readers without one.
    """
    return counted_write(df, cluster_by, lambda out: out.mode(mode).format("parquet").saveAsTable(name))


def load_dimensions(dimensions: Mapping[str, DataFrame], database: str | None = None) -> dict[str, int]:
    """Append every dimension; run before the fact is loaded."""
    return {name: write_table(df, qualified(name, database)) for name, df in dimensions.items()}


def read_table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    return spark.table(qualified(name, database))


def run_sql(spark: SparkSession, sql: str) -> DataFrame:
    return spark.sql(sql)
