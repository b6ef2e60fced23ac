"""Session builder with the settings the jobs are designed for.

Every operator works in any session; these settings only pick good physical plans.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# HotSpot never compiles a method beyond this many bytes of bytecode, but interprets it row by row, and one loop over
# the expressions that clean a dozen columns is such a method. Beyond the limit Spark runs the operators one by one,
# with their expressions in methods of their own, which are compiled. Spark's default is 65535.
HUGE_METHOD = ("spark.sql.codegen.hugeMethodLimit", "8000")

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Corpus queries keep their loops, so the JVM has to compile huge ones there.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str = "starwash", master: str | None = None, shuffle_partitions: int | None = None, **extra: str
) -> SparkSession:
    """``shuffle_partitions`` should put roughly 128-256 MB in a partition; adaptive execution merges
    the ones that turn out small, so on a cluster choose it for the largest shuffle."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def without_huge_methods(spark: SparkSession) -> None:
    """Set ``HUGE_METHOD`` in a running session that has no limit of its own."""
    if spark.conf.get(HUGE_METHOD[0], None) is None:
        spark.conf.set(*HUGE_METHOD)


def with_huge_methods(spark: SparkSession) -> None:
    """Take back what :func:`without_huge_methods` has set."""
    if spark.conf.get(HUGE_METHOD[0], None) == HUGE_METHOD[1]:
        spark.conf.unset(HUGE_METHOD[0])
