from __future__ import annotations

import os
import random
import threading

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from starwash.sources.csv import REJECT, MalformedCsv, ends_in_quotes, parsed_lines, scan_csv, split_rejects, write_csv
from starwash.sources.staging import stage, stage_all, staging_root, staging_scope
from starwash.sources.tables import run_sql, write_table


def test_scan_is_all_text_with_null_tokens(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('﻿a,b,c\n1,"q""z, x",NA\n" 2 ",,n/a\n3,"  ",x\n', encoding="utf-8")
    df = scan_csv(spark, str(path))
    assert df.dtypes == [("a", "string"), ("b", "string"), ("c", "string")]
    assert [tuple(r) for r in df.collect()] == [("1", 'q"z, x', None), (" 2 ", None, None), ("3", "  ", "x")]
    typed = scan_csv(spark, str(path), ["a", "b", "c"])
    assert [tuple(r) for r in typed.collect()] == [tuple(r) for r in df.collect()]


def test_scan_order_column_follows_the_file(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("a\n" + "\n".join(f"r{i:05d}" for i in range(5000)) + "\n")
    df = scan_csv(spark, str(path), ["a"], order_column="ord")
    got = [r.a for r in df.repartition(7).orderBy("ord").collect()]
    assert got == [f"r{i:05d}" for i in range(5000)]


def test_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('a,b\n"x\ny",1\n')
    assert [tuple(r) for r in scan_csv(spark, str(path), multiline=True).collect()] == [("x\ny", "1")]


def test_missing_path_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        scan_csv(spark, str(tmp_path / "none.csv"))


def test_csv_round_trip_keeps_blanks_and_quotes(spark, tmp_path):
    data = [("  a ", 'say "hi", you', 1.5), (None, "x", None)]
    df = spark.createDataFrame(data, "p string, q string, hidden double")
    write_csv(df, str(tmp_path / "out"), drop=["hidden", "absent"])
    got = scan_csv(spark, str(tmp_path / "out"), ["p", "q"]).collect()
    assert sorted((tuple(r) for r in got), key=str) == [("  a ", 'say "hi", you'), (None, "x")]


def test_staging_uses_the_shared_folder_of_the_session(spark):
    root = staging_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    df = stage(spark.range(10).selectExpr("id", "cast(null as string) as t"))
    assert df.count() == 10 and all(root in f for f in df.inputFiles())


def test_ragged_rows_end_the_read_or_become_rejects(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("a,b\n1,2\n1,2,3\n4\n5,6\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_csv(spark, str(path), ["a", "b"]).select("a").collect()
    good, bad = split_rejects(scan_csv(spark, str(path), ["a", "b"], rejects=REJECT))
    assert sorted(tuple(r) for r in good.collect()) == [("1", "2"), ("5", "6")]
    assert sorted(r[0] for r in bad.collect()) == ["1,2,3", "4"]


def test_line_breaks_in_quotes_are_reported(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('a,b\n"x\ny",5\n')
    with pytest.raises(MalformedCsv):
        scan_csv(spark, str(path))


def test_typed_scan(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("a,b\n1,2.5\nx,NA\n")
    got = scan_csv(spark, str(path), ["a", "b"], types={"a": "bigint", "b": "double"})
    assert got.dtypes == [("a", "bigint"), ("b", "double")]
    assert sorted((tuple(r) for r in got.collect()), key=str) == [(1, 2.5), (None, None)]


def test_staging_scopes_delete_what_they_staged(spark):
    kept = stage(spark.range(3))
    with staging_scope(spark):
        inner = stage_all({"a": lambda: spark.range(5), "b": lambda: spark.range(6)})
        with staging_scope(spark):
            stage(spark.range(7))
        files = [f.removeprefix("file:") for df in inner.values() for f in df.inputFiles()]
        assert inner["b"].count() == 6 and all(os.path.exists(f.replace("//", "")) or os.path.exists(f) for f in files)
    assert not any(os.path.exists(f) or os.path.exists(f.replace("//", "")) for f in files)
    assert kept.count() == 3


def test_write_table_counts_rows(spark):
    spark.sql("DROP TABLE IF EXISTS counted")
    assert write_table(spark.range(5), "counted") == 5
    assert write_table(spark.range(3), "counted", cluster_by="id") == 3
    assert run_sql(spark, "select count(*) as n from counted").first().n == 8
    assert write_table(spark.range(2), "counted", mode="overwrite") == 2
    assert spark.table("counted").count() == 2


@pytest.mark.parametrize("line,opened", [
    ("plain,line", False), ('pipe 5" wide,3', False), ('"x', True), ('a,"x', True), ('a,"x""', True), ('a,"x"""', False),
    ('"a","b"', False), ('"a","b', True), ('"a"b"c,"d', True), ('5" wide,"open', True), ('"a,b', True), ('"a,b",c', False),
    ("", False), ('""', False), ('"",""', False), (',,"', True), ('a"b,"c"d",e', False), ('x,"' + 'y' * 5000, True),
    (",".join(['"a""b"'] * 20000), False), (",".join(['"a""b"'] * 20000) + ',"', True),
])
def test_lines_that_end_inside_quotes(spark, line, opened):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(ends_in_quotes(F.col("line"))).first()[0] is opened


def test_lines_that_end_inside_quotes_against_a_state_machine(spark):
    def plain(line):
        state = "start"
        i = 0
        while i < len(line):
            c = line[i]
            if state == "start":
                state = "quoted" if c == '"' else "start" if c == "," else "text"
            elif state == "quoted":
                if c == '"':
                    if line[i + 1 : i + 2] == '"':
                        i += 1
                    else:
                        state = "text"
            elif c == ",":
                state = "start"
            i += 1
        return state == "quoted"

    rng = random.Random(4)
    lines = ["".join(rng.choice('",a') for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = {r[0]: r[1] for r in df.select("line", ends_in_quotes(F.col("line"))).collect()}
    assert all(got[x] == plain(x) for x in lines)


def test_stray_quotes_load_and_the_files_are_read_once(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('item,size\npipe 5" wide,3\n"a, ""b""",4\n"",5\n')
    assert [tuple(r) for r in scan_csv(spark, str(path)).collect()] == [('pipe 5" wide', "3"), ('a, "b"', "4"), (None, "5")]
    plan = parsed_lines(spark, str(path), ["item", "size"], True, None, False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert all(  # the result reads the staged columns only
        str(tmp_path) not in f for f in scan_csv(spark, str(path)).inputFiles()
    )


def test_a_broken_row_behind_a_line_break_is_reported_as_line_break(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('a,b,c\n1,2,3\n4,"x\ny",6\n')
    with pytest.raises(MalformedCsv, match="line break"):
        scan_csv(spark, str(path))


def test_headers_are_checked(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,2\n")
    with pytest.raises(MalformedCsv, match="header"):
        scan_csv(spark, str(tmp_path / "one.csv"), ["a", "c"])
    (tmp_path / "two.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, str(tmp_path), ["a", "b"]).collect()


def test_ordinal_over_several_files_and_splits(spark, tmp_path):
    for f in range(3):
        (tmp_path / f"f{f}.csv").write_text("k,v\n" + "".join(f"{f}-{i:05d},{'x' * (i % 50)}\n" for i in range(3000 * (3 - f))))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = scan_csv(spark, str(tmp_path), order_column="ord")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert dict(df.dtypes)["ord"] == "bigint"
    rows = df.orderBy("ord").collect()
    assert [r.k for r in rows] == sorted(r.k for r in rows) and len({r.ord for r in rows}) == 18000


def test_columns_of_a_csv_may_have_the_names_used_inside(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("file,split,row,record,open,line,a`b\n1,2,3,4,5,6,7\n")
    got = scan_csv(spark, str(path), order_column="ord").drop("ord").first()
    assert got.asDict() == {"file": "1", "split": "2", "row": "3", "record": "4", "open": "5", "line": "6", "a`b": "7"}


def random_csv(rng, rows, columns):
    """Proper CSV with breaks, quotes and commas inside quoted fields and quotes inside plain ones."""
    def field():
        kind = rng.random()
        if kind < 0.25:
            text = "".join(rng.choice(["\n", '"', ",", "a", " b", "\n\n"]) for _ in range(rng.randint(0, 9)))
            return '"' + text.replace('"', '""') + '"', text
        plain = rng.choice(["x", "yy", 'pipe 5" wide', "1", 'a"b"c'])
        return plain, plain

    made = [[field() for _ in range(columns)] for _ in range(rows)]
    return "\n".join(",".join(raw for raw, _ in row) for row in made) + "\n", [tuple(t or None for _, t in row) for row in made]


@pytest.mark.parametrize("split", [900, 100_000])
def test_records_of_several_lines_over_splits(spark, tmp_path, split):
    rng, expected = random.Random(split), []
    for f in range(3):
        text, rows = random_csv(rng, 150, 3)
        (tmp_path / f"f{f}.csv").write_text("a,b,c\n" + text)
        expected += rows
    settings = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = scan_csv(spark, str(tmp_path), order_column="ord", multiline=True)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = [tuple(r) for r in df.orderBy("ord").drop("ord").collect()]
    tokens = {"", None}
    assert [tuple(None if x in tokens else x for x in r) for r in got] == expected


def test_multiline_files_without_header_blank_lines_and_open_ends(spark, tmp_path):
    (tmp_path / "one.csv").write_text('\n1,"a\n\n  b"\n\n\n2,"c ""d\n"""\n')
    got = scan_csv(spark, str(tmp_path / "one.csv"), ["k", "v"], multiline=True, header=False)
    assert sorted(tuple(r) for r in got.collect()) == [("1", "a\n\n  b"), ("2", 'c "d\n"')]
    (tmp_path / "two.csv").write_text('k,v\n1,"never\nclosed\n2,x\n')
    with pytest.raises(MalformedCsv, match="never closes"):
        scan_csv(spark, str(tmp_path / "two.csv"), multiline=True)
    (tmp_path / "three.csv").write_text('k,v\n1,"a\nb",9\n2,"x\ny"\n')
    good, bad = split_rejects(scan_csv(spark, str(tmp_path / "three.csv"), multiline=True, rejects=REJECT))
    assert [tuple(r) for r in good.collect()] == [("2", "x\ny")] and [r[0] for r in bad.collect()] == ['1,"a\nb",9']
    (tmp_path / "four.csv").write_text("k,v\n")
    assert scan_csv(spark, str(tmp_path / "four.csv"), multiline=True).collect() == []


def test_scopes_of_two_threads_do_not_touch_each_other(spark):
    ready, done = threading.Barrier(2), threading.Event()
    kept = {}

    def first():
        with staging_scope(spark):
            ready.wait(60)
            done.wait(60)

    def second():
        with staging_scope(spark):
            ready.wait(60)
            kept["df"] = stage(spark.range(4))
            done.set()
            other.join(60)  # the first scope has ended
            kept["n"] = kept["df"].count()

    other = threading.Thread(target=first)
    other.start()
    second()
    assert kept["n"] == 4
