from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from starwash.operators import checks, dedupe, fill, ordering, outliers, profile, quantiles, star


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


@pytest.fixture(scope="module")
def hot(spark):
    """20,000 rows, one key holding more than a third, values often missing."""
    rng = random.Random(7)
    data = []
    for i in range(20000):
        key = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None, f"k{rng.randrange(3000)}"])
        value = f"v{i}" if rng.random() < 0.02 else None
        data.append((key, i, value))
    rng.shuffle(data)
    pdf = pd.DataFrame(data, columns=["k", "o", "v"])
    return spark.createDataFrame(data, "k string, o long, v string").repartition(16), pdf.sort_values("o")


def test_keep_first_does_not_depend_on_partitioning(hot):
    df, pdf = hot
    want = sorted(((k if isinstance(k, str) else None, o) for k, o in pdf.drop_duplicates("k")[["k", "o"]].values), key=str)
    assert rows(dedupe.keep_first(df, "k", "o"), "k", "o") == want
    assert rows(dedupe.keep_first(df.repartition(3), "k", "o"), "k", "o") == want


def test_keep_first_usable(hot):
    df, pdf = hot
    known = pdf[pdf.v.notna() & pdf.k.notna()]
    want = sorted(map(tuple, known.drop_duplicates("k")[["k", "o"]].values), key=str)
    assert rows(dedupe.keep_first(df, "k", "o", F.col("v").isNotNull() & F.col("k").isNotNull()), "k", "o") == want


def test_rows_with_repeated_key(hot):
    df, pdf = hot
    want = sorted(pdf[pdf.duplicated("k", keep=False)].o.tolist())
    assert sorted(r.o for r in dedupe.rows_with_repeated_key(df, "k").collect()) == want


def test_fill_within_group_with_a_hot_key(hot):
    df, pdf = hot
    keyed = pdf[pdf.k.notna()].copy()
    keyed["v"] = keyed.groupby("k")["v"].transform(lambda s: s.ffill().bfill())
    want = {o: v for o, v in keyed[["o", "v"]].values}
    out = ordering.fill_within_group(df, "k", "v", "o")
    assert out.columns == df.columns
    got = {r.o: r.v for r in out.filter("k is not null").collect()}
    assert {o: v if isinstance(v, str) else None for o, v in want.items()} == got
    assert out.filter("k is null").count() == pdf.k.isna().sum()


def test_dense_ids_are_one_to_n_in_key_order(spark):
    keys = [f"{i * 7919 % 5003:05d}" for i in range(5003)] + [None]
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(5)
    got = ordering.with_dense_ids(df, "k", "id").orderBy("id").collect()
    assert [r.id for r in got] == list(range(1, len(keys) + 1))
    assert [r.k for r in got] == sorted(k for k in keys if k) + [None]


def test_dense_ids_of_nothing(spark):
    assert ordering.with_dense_ids(spark.createDataFrame([], "k string"), "k", "id").collect() == []


def test_exact_quantiles_match_linear_interpolation(spark):
    rng = np.random.default_rng(3)
    a = np.concatenate([rng.normal(size=3001), np.full(2500, 0.25)])
    b = rng.integers(0, 9, size=a.size).astype(float)
    data = [(float(x), float(y) if i % 3 else None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(data, "a double, b double").repartition(7)
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r.column, r.probability): r.value for r in quantiles.exact_quantiles(df, ["a", "b"], probabilities).collect()}
    known_b = np.array([y for _, y in data if y is not None])
    for p in probabilities:
        assert got["a", p] == pytest.approx(np.quantile(a, p), rel=1e-12)
        assert got["b", p] == pytest.approx(np.quantile(known_b, p), rel=1e-12)


def test_quartiles_of_the_golden_rows(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,), (float("nan"),)], "x double")
    r = quantiles.iqr_bounds(df, "x").first()
    assert (r.q1, r.q3, r.iqr, r.lower_bound, r.upper_bound) == (1.75, 3.25, 1.5, -0.5, 5.5)


def test_capping_spares_promotions_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, None, "N"), (2, 5.0, "N"), (3, 50.0, "N"), (4, 50.0, "Y"), (5, -9.0, None)], "i int, a double, p string"
    )
    bounds = spark.createDataFrame([(1.0, 10.0)], "lower_bound double, upper_bound double")
    flagged = outliers.flag_outliers(df, bounds, "a", "p")
    assert rows(flagged, "i", outliers.FLAG, "Promo_Outside_Bounds") == [
        (1, False, False), (2, False, False), (3, True, False), (4, False, True), (5, True, False)
    ]
    capped = outliers.cap_outliers(df, bounds, "a", "p", before="old")
    assert rows(capped, "i", "a", "old") == [(1, None, None), (2, 5.0, 5.0), (3, 10.0, 50.0), (4, 50.0, 50.0), (5, 1.0, -9.0)]
    assert capped.filter(outliers.changed(F.col("a"), F.col("old"))).count() == 2


def test_boxplot(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 5, 100]], "x double")
    r = quantiles.boxplot_statistics(df, ["x"]).first()
    assert (r.whisker_low, r.q1, r.median, r.q3, r.whisker_high, r.n_outliers) == (1.0, 2.25, 3.5, 4.75, 5.0, 1)


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (None, None)], "a int, b string")
    assert dedupe.duplicate_row_count(df).first().duplicate_rows == 1
    assert dedupe.drop_exact_duplicates(df).count() == 3
    assert dedupe.duplicate_key_count(df, "a").first().duplicate_keys == 2


def test_near_duplicates(spark):
    data = [("1", "Tom", "t@x", False), ("1", "Tom", "t@x", False), ("2", "Thomas", "t@x", False),
            ("3", "Ann", "a@x", False), ("4", "P", "u@x", True), ("5", "Q", "u@x", True)]
    df = spark.createDataFrame(data, "id string, name string, email string, missing boolean")
    got = dedupe.near_duplicate_customers(df, "email", "name", ["id", "name", "email"], "missing")
    assert rows(got) == [("1", "Tom", "t@x"), ("2", "Thomas", "t@x")]


def test_fill_from_same_key(spark):
    df = spark.createDataFrame(
        [("s1", None, 1), ("s1", "", 2), ("s1", "North", 3), ("s1", "South", 4), ("s2", None, 5), (None, None, 6)],
        "s string, r string, o int",
    )
    assert rows(fill.fill_from_same_key(df, "s", "r", "o"), "o", "r") == [
        (1, "North"), (2, "North"), (3, "North"), (4, "South"), (5, None), (6, None)
    ]


def test_incomplete_rows_split_the_table(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "x double, t string")
    assert rows(fill.drop_incomplete(df, ["x", "t"])) == [(1.0, "a")]
    assert fill.keep_incomplete(df, ["x", "t"]).count() == 3


def test_lookup_matches_null_with_null(spark):
    facts = spark.createDataFrame([("a",), (None,), ("z",)], "k string")
    dim = spark.createDataFrame([("a", 1), (None, 2)], "name string, id long")
    got = star.lookup_id(facts, F.col("k"), dim, F.col("name"), "id")
    assert rows(got, "k", "id") == [("a", 1), ("z", None), (None, 2)]


def test_filled_dimension(spark):
    df = spark.createDataFrame(
        [("p", "P one", None, 1), ("p", "P two", "food", 2), ("p", "P", "toys", 3), ("q", "Q", None, 4)],
        "k string, n string, c string, o int",
    )
    got = star.build_filled_dimension(df, "k", "n", "c", "Uncategorized", "id", "o")
    assert rows(got) == [(1, "P one", "food"), (2, "Q", "Uncategorized")]


def test_constraints(spark):
    fact = spark.createDataFrame([("o1", 1, 1.0), ("o2", 9, None), ("o2", 9, 2.0)], "oid string, c long, x double")
    dim = spark.createDataFrame([(1,)], "c long")
    assert rows(checks.foreign_key_orphans(fact, {"c": dim})) == [("c", 9, 2)]
    assert rows(checks.not_null_violations(fact, ["oid", "x"])) == [("x", 1)]
    assert rows(checks.unique_violations(fact, "oid")) == [("o2", 2)]
    for broken in (
        lambda: checks.require_foreign_keys(fact, {"c": dim}),
        lambda: checks.require_unique(fact, "oid"),
        lambda: checks.require_not_null(fact, ["x"]),
        lambda: checks.require_rows(fact.filter("false")),
    ):
        with pytest.raises(checks.ValidationError):
            broken()
    checks.require_foreign_keys(fact.filter("c = 1"), {"c": dim})
    checks.require_rows(fact)


def test_expectations(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (None, "b", 9.0), (99, None, None)], "q int, s string, x double")
    got = checks.check_expectations(df, [
        checks.expect_not_null("q"), checks.expect_between("q", 1, 20), checks.expect_in_set("s", ["a", "b"]),
        checks.expect_within("x", F.lit(1.0), 2.0, applies=F.col("s") == "a"),
    ]).collect()
    assert [tuple(r) for r in got] == [
        ("not_null", "q", 3, 1, False), ("between", "q", 3, 2, False), ("in_set", "s", 3, 1, False),
        ("within_threshold", "x", 1, 0, True),
    ]


def test_profile(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (2, None, float("nan")), (3, "b", 2.0), (3, "b", 2.0)], "i int, t string, x double"
    )
    assert rows(profile.missing_profile(df)) == [("t", 1, 25.0), ("x", 1, 25.0)]
    schema = {r.column: r for r in profile.schema_profile(df).collect()}
    assert (schema["x"].dtype, schema["x"].non_null_count, schema["x"].n_rows, schema["x"].n_columns) == ("double", 3, 4, 3)
    assert rows(profile.distinct_counts(df, ["t", "i"])) == [("i", 3), ("t", 2)]
    assert [tuple(r) for r in profile.value_counts(df, "t").collect()] == [("b", 2), ("a", 1), (None, 1)]
    text = profile.describe_texts(df, ["t"]).first()
    assert (text["count"], text["unique"], text["top"], text["freq"]) == (3, 2, "b", 2)
    number = profile.describe_numbers(df, ["i"]).first()
    assert (number["count"], number["mean"], number["min"], number["median"], number["max"]) == (4, 2.25, 1.0, 2.5, 3.0)
    assert number["std"] == pytest.approx(np.std([1, 2, 3, 3], ddof=1))
    report = profile.extract_report(df, "i")
    assert report["duplicates"].first().duplicate_rows == 1 and report["preview"].count() == 4


def test_profiles_keep_columns_without_values(spark):
    df = spark.createDataFrame(
        [(1, None, "x", "2024-01-01", "1.50"), (2, None, "x", "2024-01-03", "2.50")],
        "n int, nothing double, t string, d string, m string",
    ).selectExpr("n", "nothing", "t", "cast(null as string) as blank", "cast(d as date) as d", "cast(m as decimal(9,2)) as m")
    counts = {r["column"]: r.n_distinct for r in profile.distinct_counts(df, df.columns).collect()}
    assert counts == {"n": 2, "nothing": 0, "t": 1, "blank": 0, "d": 2, "m": 2}
    described = {r["column"]: r for r in profile.describe_all(df).collect()}
    assert set(described) == set(df.columns)
    assert (described["nothing"]["count"], described["nothing"].mean, described["nothing"].unique) == (0, None, None)
    assert (described["blank"]["count"], described["blank"].unique, described["blank"].top) == (0, 0, None)
    assert (described["m"].mean, described["m"].top, described["t"].unique) == (2.0, None, 1)
    (dates,) = profile.describe_dates(df, ["d"]).collect()
    assert [str(dates[c])[:10] for c in ("min", "median", "max")] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert "dates" in profile.extract_report(df)


@pytest.mark.parametrize("chunks", [1, 3, 40])
def test_chunk_count_does_not_change_results(hot, chunks):
    hot = hot[0]
    usual = rows(ordering.fill_within_group(hot, "k", "v", "o"))
    assert rows(ordering.fill_within_group(hot, "k", "v", "o", chunks=chunks)) == usual
    ids = ordering.with_dense_ids(hot.select("o"), "o", "id", chunks=chunks)
    assert rows(ids, "o", "id") == rows(ordering.with_dense_ids(hot.select("o"), "o", "id"), "o", "id")
    known = rows(quantiles.exact_quantiles(hot, ["o"], (0.1, 0.5)))
    assert rows(quantiles.exact_quantiles(hot, ["o"], (0.1, 0.5), chunks=chunks)) == known


def test_first_per_key_with_null_keys_and_missing_values(spark):
    rng = random.Random(8)
    data = [(rng.choice(["a", "b", None, "hot", "hot"]), o, rng.choice([None, None, "", f"v{o}"]), f"w{o}") for o in range(500)]
    data += [("never", 500, None, "w500")]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, o long, v string, w string").repartition(7)
    got = ordering.first_per_key(df, "k", "o", {"w": None, "v": F.col("v") != ""})
    want = {}
    for k, _, v, w in sorted(data, key=lambda r: r[1]):
        old = want.setdefault(k, [w, None])
        old[1] = old[1] or (v or None)
    assert {r.k: [r.w, r.v] for r in got.collect()} == want
    known = ordering.first_per_key(df, "k", "o", {"v": F.col("v") != ""}, join_null=False)
    assert {r.k: r.v for r in known.collect()} == {k: v for k, (_, v) in want.items() if k is not None and v}


def test_ordinal_follows_the_order(spark):
    df = spark.range(3000).selectExpr("(id * 7919) % 3001 as a", "cast(id % 3 as string) as b").repartition(6)
    out = ordering.with_ordinal(df, "o", "b", "a").orderBy("o").collect()
    assert [(r.b, r.a) for r in out] == sorted((r.b, r.a) for r in out) and len({r.o for r in out}) == 3000


@pytest.mark.parametrize("error", [1e-4, 0.02, 0.3])
def test_quantiles_do_not_depend_on_the_sketch(spark, error):
    rng = random.Random(9)
    values = [rng.choice([5.0, 5.0, rng.gauss(0, 10), None, float("nan"), -0.0]) for _ in range(3000)]
    df = spark.createDataFrame([(v, float(i)) for i, v in enumerate(values)], "a double, b double").repartition(5)
    probabilities = (0.0, 0.01, 0.25, 0.5, 0.75, 1.0)
    known = sorted(v for v in values if v is not None and v == v)
    got = {(r.column, r.probability): r.value for r in quantiles.exact_quantiles(df, ["a", "b"], probabilities, error=error).collect()}
    for p in probabilities:
        assert got["a", p] == pytest.approx(np.percentile(known, 100 * p))
        assert got["b", p] == pytest.approx(np.percentile(range(3000), 100 * p))


def test_a_rank_outside_its_bracket_is_found_all_the_same(spark, monkeypatch):
    df = spark.range(1000).selectExpr("cast(id as double) as a")
    monkeypatch.setattr(quantiles, "_brackets", lambda *_: {"a": [(10.0, 20.0), (900.0, 901.0)]})
    got = {r.probability: r.value for r in quantiles.exact_quantiles(df, ["a"], (0.25, 0.5)).collect()}
    assert got == {0.25: 249.75, 0.5: 499.5}
    assert "outside" not in quantiles.exact_quantiles(df, ["a"], (0.25,)).columns


def test_only_values_near_the_wanted_ranks_are_shuffled(spark):
    df = spark.range(200_000).selectExpr("cast(id as double) as a").repartition(8)
    brackets = quantiles._brackets(df, ["a"], quantiles.QUARTILES, quantiles.SKETCH_ERROR)
    assert quantiles._bracketed_counts(df, brackets).count() < 1000


def test_distinct_sketch_is_within_its_error(spark):
    df = spark.range(60_000).selectExpr("id % 20000 as a", "cast(null as string) as b", "'x' as c")
    got = {r["column"]: r.n_distinct for r in profile.distinct_counts(df, ["a", "b", "c"], error=0.02).collect()}
    assert abs(got["a"] - 20_000) < 3 * 0.02 * 20_000 and (got["b"], got["c"]) == (0, 1)


def test_rows_that_share_a_digest_all_stay(spark, monkeypatch):
    data = [(1, "a", 0.0), (1, "a", -0.0), (1, None, None), (None, "a", 1.0), (2, "b", float("nan")), (2, "b", float("nan")), (3, "c", 2.0)]
    df = spark.createDataFrame(data, "i int, t string, x double").repartition(3)
    assert dedupe.drop_exact_duplicates(df).count() == 5 and dedupe.duplicate_row_count(df).first()[0] == 2
    monkeypatch.setattr(dedupe, "row_digest", lambda df: F.struct(F.lit(1).cast("bigint").alias("a"), F.lit(2).cast("bigint").alias("b")))
    assert dedupe.drop_exact_duplicates(df).count() == 5 and dedupe.duplicate_row_count(df).first()[0] == 2


def test_digests_tell_which_column_is_null(spark):
    df = spark.createDataFrame([("x", None), (None, "x"), ("x", None)], "a string, b string")
    assert df.select(dedupe.row_digest(df)).distinct().count() == 2
    assert dedupe.drop_exact_duplicates(df).count() == 2
    nested = spark.sql("select map('a', 1) as m")
    assert dedupe.row_digest(nested) is None
    once = spark.range(5).selectExpr("id", "array(cast(0.0 as double)) as x")
    assert dedupe.drop_exact_duplicates(once).count() == 5 and dedupe.duplicate_row_count(spark.range(3)).first()[0] == 0


def test_digests_are_what_is_shuffled_of_wide_rows(spark):
    wide = spark.range(2000).selectExpr("id", *[f"repeat(cast(id as string), 50) as c{i}" for i in range(10)])
    once, again = dedupe._parted(wide, dedupe.row_digest(wide))
    assert again is None and "Exchange" not in once._jdf.queryExecution().executedPlan().toString()


def test_quarantine_agrees_with_the_counts(spark):
    df = spark.createDataFrame([(1, 5.0, "a"), (2, 50.0, "z"), (None, None, "a"), (4, 1.0, None)], "i int, x double, t string")
    rules_of = [
        checks.expect_not_null("i"), checks.expect_between("x", 0, 10), checks.expect_in_set("t", ["a", "b"]),
        checks.expect_within("x", F.lit(4.0), 2.0, F.col("i") > 1),
    ]
    found = checks.quarantine(df, rules_of)
    assert rows(found.counts) == rows(checks.check_expectations(df, rules_of))
    assert [tuple(r) for r in found.accepted.collect()] == [(1, 5.0, "a")]
    reasons = {(r.i, r.t): r.reasons for r in found.rejected.collect()}
    assert reasons == {
        (2, "z"): ["between(x)", "in_set(t)", "within_threshold(x)"], (None, "a"): ["not_null(i)", "between(x)"],
        (4, None): ["in_set(t)", "within_threshold(x)"],
    }
    empty = checks.quarantine(df.filter("false"), rules_of)
    assert rows(empty.counts) == rows(checks.check_expectations(df.filter("false"), rules_of))
    with pytest.raises(ValueError):
        checks.quarantine(df, rules_of * 20)


def test_foreign_keys_of_several_types_in_one_pass(spark):
    fact = spark.createDataFrame([(1, "a"), (1, "b"), (9, "a"), (None, None), (9, "zz")], "i long, t string")
    dims = {"i": spark.createDataFrame([(1,)], "i long"), "t": spark.createDataFrame([("a",), ("b",)], "t string")}
    found = checks.foreign_key_orphans(fact, dims)
    assert {tuple(r) for r in found.collect()} == {("i", "9", 2), ("i", None, 1), ("t", "zz", 1), ("t", None, 1)}


def test_a_report_scans_its_table_three_times(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(300).selectExpr("id", "id % 7 as k", "cast(id % 3 as string) as t", "date'2024-01-01' as d").write.parquet(path)
    df = spark.read.parquet(path)
    report = profile.extract_report(df, "id")  # one scan into the frequency table, one into the digests
    scans = {part: plan(table).count(f"[file:{path}") for part, table in report.items()}
    assert {part for part, n in scans.items() if n} == {"preview"} and scans["preview"] == 1
    assert {r["column"]: r.n_distinct for r in report["distinct"].collect()} == {"k": 7, "t": 3, "d": 1}
    assert rows(report["schema"]) == rows(profile.schema_profile(df.drop("id")))
    assert rows(report["missing"]) == rows(profile.missing_profile(df.drop("id")))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
