"""Work that grew too fast on large tables: loops the JVM never compiles, values computed twice, needless columns and sorts."""

from __future__ import annotations

import glob
import itertools
import os
import re
import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from starwash.functions import dates, numeric, text
from starwash.operators import ordering
from starwash.plans import order_warehouse as warehouse, retail_sales as retail
from starwash.session import HUGE_METHOD
from starwash.sources.staging import REMOVE_SHUFFLES, shuffles_removed, stage, stage_all, staged_path
from starwash.workload import queries, views
from starwash.workload.queries import QUERIES


@pytest.fixture
def no_limit(spark):
    spark.conf.unset(HUGE_METHOD[0])
    yield
    spark.conf.unset(HUGE_METHOD[0])


@pytest.fixture
def tables(spark):
    """Three orders with four line items, rows of their own."""
    path = staged_path(spark)
    line = [(o, p, 1, n, 2.0, 30.0, 0.1, 0.0, "N", "O", "1997-03-04") for o, p, n in ((1, 1, 1), (1, 2, 2), (2, 1, 1), (59, 9, 1))]
    rows = {
        "lineitem": spark.createDataFrame(line, " string, ".join(views.LINEITEM_ORDER) + " string").select(
            *[F.col(c).cast({"l_linenumber": "int", "l_shipdate": "timestamp", "l_returnflag": "string", "l_linestatus": "string"}.get(
                c, "bigint" if c.endswith("key") else "double")).alias(c) for c in views.LINEITEM_ORDER]
        ),
        "orders": spark.createDataFrame([(1, 7), (2, None)], "o_orderkey bigint, o_custkey bigint"),
        "customer": spark.createDataFrame([(7, "ann")], "c_custkey bigint, c_name string"),
        "part": spark.createDataFrame(
            [(1, "red box", "BOX", 15.0), (2, None, None, None)],
            "p_partkey bigint, p_name string, p_type string, p_retailprice double",
        ),
    }
    for name, df in rows.items():
        df.coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return path


def longest_run_method(spark, df) -> int:
    """Bytes of bytecode of the longest generated method that a stage of ``df`` runs, by Spark's limit."""
    limit, longest = int(spark.conf.get(HUGE_METHOD[0])), 0
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan has no code before it runs
    try:
        trees = df.select("*")._jdf.queryExecution().debug().codegenToSeq()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    for i in range(trees.size()):
        size = trees.apply(i)._3().maxMethodCodeSize()
        longest = max(longest, size if size <= limit else 0)
    return longest


def test_queries_run_no_method_that_the_jvm_leaves_to_its_interpreter(spark, no_limit, tables):
    typed = warehouse.standardize(queries._raw_orders(spark, tables), None)
    assert longest_run_method(spark, typed) > 8000  # as Spark has it
    entry.queries()["clean_sales_b"](spark, tables)
    assert spark.conf.get(HUGE_METHOD[0]) == HUGE_METHOD[1]
    typed = warehouse.standardize(queries._raw_orders(spark, tables), None)
    assert longest_run_method(spark, typed) <= 8000


def test_a_limit_of_the_session_stays(spark, no_limit, tables):
    spark.conf.set(HUGE_METHOD[0], "9000")
    entry.queries()["clean_sales_b"](spark, tables)
    assert spark.conf.get(HUGE_METHOD[0]) == "9000"
    entry._without_limit(lambda s, d: None)(spark, tables)
    assert spark.conf.get(HUGE_METHOD[0]) == "9000"


def test_corpus_queries_run_as_spark_has_it(spark, no_limit):
    entry._with_limit(lambda s, d: None)(spark, "")
    entry._without_limit(lambda s, d: None)(spark, "")
    assert spark.conf.get(HUGE_METHOD[0], None) is None


@pytest.mark.parametrize("parse", [numeric.parse_currency, numeric.parse_number])
def test_numbers_are_parsed_once(spark, parse):
    df = spark.createDataFrame([("1",)], "t string").select(parse(F.col("t")).alias("v"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("cast(") == 1


def test_numbers_that_are_not_finite(spark):
    texts = ["1e400", "-1e400", "-0.0", "-2.5", "9" * 400, "(" + "9" * 400 + ")", "(3.00)", " (3)", "(3", "4,000.5", None, "NaN", "inf"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select(numeric.parse_number(F.col("t")), numeric.parse_currency(F.col("t"))).collect()
    assert [r[0] for r in got] == [None, None, -0.0, -2.5, *[None] * 9]
    assert [r[1] for r in got] == [None, None, -0.0, -2.5, None, None, -3.0, -3.0, None, 4000.5, None, None, None]
    values = spark.createDataFrame([(x,) for x in (1.5, -1.5, float("inf"), -float("inf"), float("nan"), None, 1.7e308)], "x double")
    assert [r[0] for r in values.select(numeric.finite(F.col("x"))).collect()] == [1.5, -1.5, None, None, None, None, 1.7e308]


def test_dates_with_any_white_space_around(spark):
    texts = [" 2024-01-05 ", "\n05/01/2024\n", "\t05-Jan-2024 ", "x2024-01-05", "2024-01-05 x", "2024-01-05\nx", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select(dates.parse_dates(F.col("t")), dates.parse_flexible_date(F.col("t"))).collect()
    assert [[str(v) for v in r] for r in got] == [["2024-01-05"] * 2] * 3 + [["None"] * 2] * 4


def test_the_ordinal_keeps_only_the_columns_that_are_read(spark, tables, monkeypatch):
    staged = []
    monkeypatch.setattr(ordering, "stage", lambda df, real=ordering.stage: staged.append(df.columns) or real(df))
    queries._raw_orders(spark, tables, order=True).collect()
    assert set(staged[0]) == {
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate", "_chunk", "_pos"
    }


@pytest.mark.parametrize("name", ["rejected_orders", "not_null_violations"])
def test_rows_judged_one_by_one_are_not_sorted(spark, tables, monkeypatch, name):
    monkeypatch.setattr(views, "with_ordinal", None)
    assert QUERIES[name](spark, tables).collect()


def test_orders_are_standardized_once_for_the_rows_the_fact_leaves_out(spark, tables, monkeypatch):
    calls = []
    real = warehouse.standardize
    monkeypatch.setattr(warehouse, "standardize", lambda *a: calls.append(a) or real(*a))
    rows = QUERIES["fact_unmatched"](spark, tables)
    assert len(calls) == 1
    raw = queries._raw_orders(spark, tables, order=True)
    want = warehouse.fact_unmatched(real(raw), warehouse.build_dimensions(warehouse.clean(raw)))
    assert sorted(map(str, rows.collect())) == sorted(map(str, want.collect())) != []
    assert "regexp_replace" not in rows._jdf.queryExecution().optimizedPlan().toString()


def every_text(*alphabets):
    return [("".join(t),) for t in itertools.product(*alphabets)]


def test_dates_of_ten_characters_are_those_of_the_regex(spark):
    """Two characters of a date replaced by others, among them what a cast takes and the regex does not."""
    texts = {(None,), ("",), ("0000-01-05",), ("05/01/0000",), ("2023-02-29",), ("29/02/2023",), ("31/04/2024",)}
    for date in ("2024-01-05", "05/01/2024", "05-01-2024", "2024/01/05"):
        for i, j in itertools.combinations(range(10), 2):
            for a, b in itertools.product(" T1-/\x00٠", repeat=2):
                changed = list(date)
                changed[i], changed[j] = a, b
                texts |= {("".join(changed),), ("".join(changed) + a,), (a + "".join(changed),)}
    c, n = F.col("t"), [0, 0]
    rows = spark.createDataFrame(sorted(texts, key=str), "t string")
    for i, (year_first, day_first) in enumerate((("-", "/"), ("[-/]", "[-/]"))):
        ymd = rf"({dates.YEAR}){year_first}({dates.MONTH}){year_first}({dates.DAY})"
        dmy = rf"({dates.DAY}){day_first}({dates.MONTH}){day_first}({dates.YEAR})"
        slow = dates._rearranged(c, f"{dates.AROUND}(?:{ymd}|{dmy}){dates.AROUND}", "$1$6-$2$5-$3$4")
        by_place = F.coalesce(*dates._ten_characters(c))
        read = rows.select("t", slow.alias("slow"), by_place.alias("place"), dates._numeric_date(c, year_first, day_first).alias("got"))
        assert read.filter("not got <=> slow or (place is not null and not place <=> slow)").collect() == []
        n[i] = read.filter("place is not null").count()
    assert n[0] == n[1] > 50


def test_dates_of_eleven_characters_are_those_of_the_format(spark):
    months = [f"{d}-{m}-2024" for d in ("05", "29", "31", "00", " 5", "5 ", "T5") for m in "Jan feb MAR Apr May Jun Jul Aug Sep Oct Nov Dec anf Jax".split()]
    texts = {(m,) for m in months} | {(None,), ("",), ("05-Jan-0000",), ("29-Feb-2023",)}
    for i, a in itertools.product(range(11), " T1-/\x00٠x"):
        texts.add(("05-Jan-2024"[:i] + a + "05-Jan-2024"[i + 1:],))
    c = F.col("t")
    slow = dates._named_month(dates.strip(c), rf"^\d{{1,2}}-[A-Za-z]{{3}}-{dates.YEAR}$", "d-MMM-yyyy")
    rows = spark.createDataFrame(sorted(texts, key=str), "t string")
    read = rows.select("t", slow.alias("slow"), dates._eleven_characters(c).alias("place"), dates.parse_dates(c).alias("got"))
    assert read.filter("not got <=> slow or (place is not null and not place <=> slow)").collect() == []
    assert read.filter("place is not null").count() > 30


def test_plain_amounts_are_those_of_the_regex(spark):
    c = F.col("t")
    texts = every_text("$1 (-", *["1,.$ "] * 4) + every_text("$1", "234", ",1", "234", "5", "60", ",.7", *["01"] * 2, ".") + [(None,), ("",)]
    rows = spark.createDataFrame(texts, "t string")
    trimmed = F.trim(c)
    signed = F.when(trimmed.startswith("("), F.regexp_replace(trimmed, numeric.BRACKETS, "-$1")).otherwise(trimmed)
    digits = F.regexp_replace(signed, numeric.MONEY, "$1$2$3")
    slow = numeric.finite(F.replace(digits, F.lit(",")).try_cast("double"))
    read = rows.select("t", slow.alias("slow"), numeric.parse_currency(c).alias("got"), trimmed.rlike(numeric.PLAIN_MONEY).alias("plain"))
    assert read.filter("not got <=> slow or (plain and got is null)").collect() == []
    assert read.filter("plain").count() > 100


@pytest.mark.parametrize("parse", [dates.parse_dates, dates.parse_flexible_date, numeric.parse_currency])
def test_usual_dates_and_amounts_are_not_rewritten_by_regex(spark, parse):
    parsed = spark.createDataFrame([("12",)], "t string").select(parse(F.col("t")).alias("v"))
    steps = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in steps[:steps.index("regexp_replace")]
    assert "RLIKE(trim(t" in steps or "substring(t" in steps


def cleaning(spark, clean, texts):
    """Number of projections that compute texts or numbers in ``clean`` of a table of text columns."""
    raw = spark.createDataFrame([[" a "] * len(texts) + [1]], ", ".join(f"{c} string" for c in texts) + ", ord bigint")
    return clean(raw)._jdf.queryExecution().optimizedPlan().toString().count("Project [")


def test_cleaning_copies_a_row_four_times_at_most(spark):
    """Six and seven times before: every projection copies the whole row."""
    assert cleaning(spark, warehouse.standardize, views.columns_of("orders_raw")) <= 4
    assert cleaning(spark, retail.standardize, views.columns_of("sales")) <= 4


@pytest.mark.parametrize("view, names, tables_of", [
    ("orders_raw", ["Order_ID", "Customer_Name", "Product"], ["orders", "customer", "part"]),
    ("sales", ["Sale_ID", "Region", "Product_Name"], ["orders", "customer", "nation", "region", "part"]),
])
def test_customers_meet_the_orders_before_the_line_items(spark, tables, view, names, tables_of):
    """Line items are shuffled for orders and part only; rows of null, missing or repeated keys are as before."""
    folder = staged_path(spark)
    rows = {
        "orders": ([(1, 7), (1, 7), (2, None), (59, 8)], "o_orderkey bigint, o_custkey bigint"),
        "customer": ([(7, "ann", 1), (7, "bob", 2), (None, "nil", 1)], "c_custkey bigint, c_name string, c_nationkey bigint"),
        "nation": ([(1, "PERU", 1), (1, "CUBA", None)], "n_nationkey bigint, n_name string, n_regionkey bigint"),
        "region": ([(1, "AMERICA"), (None, "NONE")], "r_regionkey bigint, r_name string"),
    }
    for t in ("lineitem", "part"):
        spark.read.parquet(f"{tables}/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    for t, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{folder}/{t}.parquet")
    got = views.dirty(spark, folder, view, names)
    build, _, source, joins = views.VIEWS[view]
    columns = ", ".join(f"{build(views.SPARK)[c][0]} as {c}" for c in names)
    flat = f"select {columns} from {source} " + " ".join(joins[t] for t in tables_of)
    named = re.sub(r"\b(from|join) (lineitem|orders|customer|nation|region|part)\b", r"\1 {\2}", flat)
    want = spark.sql(named, **{t: spark.read.parquet(f"{folder}/{t}.parquet") for t in ("lineitem", *tables_of)})
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() > 6
    lines = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins_of = [line for line in lines if "Join LeftOuter" in line]  # from the top of the tree
    below = [next(i for i, line in enumerate(joins_of) if key in line) for key in ("l_orderkey", "o_custkey")]
    assert below == sorted(below)


def test_usual_texts_are_stripped_and_read_without_a_search(spark):
    """As ``btrim`` and the regex, which only unusual texts need."""
    edges = ["", " ", "a", "7", "~", "\t", "\n", " ", "　", "é", "\x00", "\x7f", "\x1c"]
    middles = ["", "a b", "12", "1d5", "0x1p3", "0X1P3", "1f", "1e400", "nan", "Infinity", "-1.5e3", "٣", "1_000"]
    texts = [(a + m + b,) for a, m, b in itertools.product(edges, middles, edges)] + [(None,)]
    rows = spark.createDataFrame(texts, "t string")
    t = F.col("t")
    read = rows.select(
        "t", text.strip(t).alias("s"), F.btrim(t, F.lit(text.WHITE_SPACE)).alias("s0"), numeric.parse_number(t).alias("n"),
        numeric.finite(F.when(~t.rlike(numeric.JAVA_NUMBER), t.try_cast("double"))).alias("n0"),
    )
    assert read.filter("not (s <=> s0) or not (n <=> n0)").collect() == []
    assert read.filter("n is not null").count() > 50
    plan = read.select("s", "n")._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN (((substring(trim(t" in plan and plan.index("substring(t") < plan.index("RLIKE(t")


def shuffle_files(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in folders for f in glob.glob(f"{d.getPath()}/*/shuffle_*.data")}


def staged_tables(spark) -> set[str]:
    folder = staged_path(spark).rpartition("/")[0].removeprefix("file:")
    return {f"{d}/{name}" for d, names, _ in os.walk(folder) for name in names}


def counts(spark, n):
    return spark.range(1000).groupBy((F.col("id") % n).alias("k")).count()


def test_staging_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    with shuffles_removed(spark):
        one = stage(counts(spark, 7))
        both = stage_all({"a": lambda: counts(spark, 3), "b": lambda: counts(spark, 4)})
    assert not shuffle_files(spark) - before
    assert [df.count() for df in (one, both["a"], both["b"])] == [7, 3, 4]
    assert spark.conf.get(REMOVE_SHUFFLES, None) is None


def test_removing_shuffles_is_taken_back_and_a_setting_of_the_session_stays(spark):
    with pytest.raises(ZeroDivisionError):
        with shuffles_removed(spark), shuffles_removed(spark):
            assert spark.conf.get(REMOVE_SHUFFLES) == "true"
            again = counts(spark, 5)
            assert sorted(again.collect()) == sorted(again.collect())  # makes its shuffle anew
            1 / 0
    assert spark.conf.get(REMOVE_SHUFFLES, None) is None
    spark.conf.set(REMOVE_SHUFFLES, "false")
    try:
        with shuffles_removed(spark):
            assert spark.conf.get(REMOVE_SHUFFLES) == "false"
        assert spark.conf.get(REMOVE_SHUFFLES) == "false"
    finally:
        spark.conf.unset(REMOVE_SHUFFLES)


def test_cleaning_in_turn_leaves_one_staged_table_and_the_same_rows(spark):
    def raw():
        rows = spark.range(300).selectExpr(
            "if(id % 59 = 0, null, concat(' O-', id % 80)) as Order_ID", "'ann' as Customer_Name",
            "if(id % 37 = 0, null, concat('c', id % 7, '@X.y ')) as Email", "'red box' as Product",
            "if(id % 5 = 0, null, 'box') as Category", "if(id % 4 = 0, 'not_a_date', '2024-01-05') as Order_Date",
            "'2' as Quantity", "'1.50' as Unit_Price", "if(id % 3 = 0, null, concat('$', id)) as Amount", "id",
        )
        return ordering.with_ordinal(rows, "ord", F.col("id").desc()).drop("id")

    want = warehouse.clean(raw()).collect()
    before, shuffles = staged_tables(spark), shuffle_files(spark)
    got = warehouse.clean_in_turn(spark, raw)
    assert len(staged_tables(spark) - before) == 1
    assert not shuffle_files(spark) - shuffles
    assert len(want) > 50 and sorted(map(str, got.collect())) == sorted(map(str, want))


def test_appending_leaves_neither_staged_tables_nor_shuffle_files(spark, small):
    orders = warehouse.clean(queries._raw_orders(spark, small, order=True))
    early, name = F.month("order_date") <= 6, f"swept_{uuid.uuid4().hex}"

    def star_of(part):
        dimensions = warehouse.build_dimensions(part)
        return {**dimensions, "fact_sales": stage(warehouse.fact_sales(part, dimensions).dropna(subset=warehouse.FACT))}

    first, later = star_of(orders.filter(early)), star_of(orders.filter(~early))
    n_later = later["fact_sales"].count()
    spark.sql(f"CREATE DATABASE {name}")
    before, shuffles = staged_tables(spark), shuffle_files(spark)
    warehouse.load_star(spark, first, name)
    added = warehouse.append_star(spark, later, name)
    assert staged_tables(spark) == before
    assert not shuffle_files(spark) - shuffles
    assert added["fact_sales"] == n_later > 0
    spark.sql(f"DROP DATABASE {name} CASCADE")
