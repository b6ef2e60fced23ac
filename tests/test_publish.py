"""A load that is stopped between any two steps leaves the old or the new warehouse; appends keep ids."""

from __future__ import annotations

import itertools
import os
import uuid

import pytest
from pyspark.sql import functions as F

from starwash.operators import star as stars
from starwash.sources import publish
from starwash.sources.publish import Warehouse


class Stopped(Exception):
    pass


STEPS = ("counted_write", "write_text", "move", "delete", "exists")


def stop_at(monkeypatch, step: int):
    """Every file operation and catalog statement of a load is a step; the ``step``-th does not happen."""
    calls = itertools.count()

    def guard(f):
        def run(*args, **kwargs):
            if next(calls) == step:
                raise Stopped
            return f(*args, **kwargs)
        return run

    for name in STEPS:
        monkeypatch.setattr(publish, name, guard(getattr(publish, name)))
    monkeypatch.setattr(Warehouse, "_attach", guard(Warehouse._attach))
    return calls


def two_tables(spark, n):
    return {"dim": spark.range(n).withColumn("load", F.lit(n)), "fact": spark.range(2 * n).withColumn("load", F.lit(n))}


def held(read):
    return {t: [tuple(r) for r in read(t).agg(F.count("*"), F.min("load"), F.max("load")).collect()] for t in ("dim", "fact")}


OLD = {"dim": [(3, 3, 3)], "fact": [(6, 3, 3)]}
NEW = {"dim": [(5, 5, 5)], "fact": [(10, 5, 5)]}


@pytest.mark.parametrize("catalog", [True, False])
def test_a_load_stopped_anywhere_leaves_one_whole_warehouse(spark, tmp_path, monkeypatch, catalog):
    outcomes = []
    for step in itertools.count():
        root, database = f"{tmp_path}/{step}", f"pub_{uuid.uuid4().hex}" if catalog else None
        if catalog:
            spark.sql(f"CREATE DATABASE {database} LOCATION '{root}'")
        target = Warehouse(spark, f"{root}/wh", database)
        target.publish(two_tables(spark, 3))
        with monkeypatch.context() as patch:
            calls = stop_at(patch, step)
            try:
                target.publish(two_tables(spark, 5))
            except Stopped:
                pass
            else:
                assert next(calls) <= step + 1  # ran through: there are no more steps
                break
        seen = held(target.read)  # before any recovery
        assert seen in (OLD, NEW), (step, seen)
        Warehouse(spark, f"{root}/wh", database).recover()
        visible = held(lambda t: spark.table(f"{database}.{t}") if catalog else spark.read.parquet(f"{root}/wh/{t}"))
        assert visible == seen == held(target.read), step
        outcomes.append(seen == NEW)
        assert target.publish(two_tables(spark, 5)) == {"dim": 5, "fact": 10}
        assert held(target.read) == NEW
    # The old warehouse up to the rename, the new one from then on.
    assert outcomes == sorted(outcomes) and not outcomes[0] and outcomes[-1] and len(outcomes) > 6


def test_a_refused_load_changes_nothing_and_leaves_nothing(spark, tmp_path):
    target = Warehouse(spark, str(tmp_path))
    target.publish(two_tables(spark, 3))

    def refuse(tables):
        assert held(tables.__getitem__) == NEW
        raise ValueError

    with pytest.raises(ValueError):
        target.publish(two_tables(spark, 5), refuse)
    target.recover()
    assert held(target.read) == OLD and len(os.listdir(tmp_path / "versions")) == 1


def test_older_versions_go_and_races_are_lost(spark, tmp_path):
    target = Warehouse(spark, str(tmp_path), keep=1)
    for n in (3, 4, 5):
        target.publish(two_tables(spark, n))
    assert held(target.read) == NEW and len(os.listdir(tmp_path / "versions")) <= 2
    first, second = target.write(two_tables(spark, 6)), target.write(two_tables(spark, 7))
    target.switch(first)
    with pytest.raises(FileExistsError):
        target.switch(second)
    target.recover()
    assert held(target.read)["dim"] == [(6, 6, 6)]
    with pytest.raises(LookupError):
        target.read("other")


def test_a_published_table_replaces_a_managed_one(spark, tmp_path):
    name = f"pub_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}'")
    spark.sql(f"CREATE TABLE {name}.dim (other STRING) USING parquet")
    target = publish.warehouse_of(spark, name)
    target.publish(two_tables(spark, 3))
    assert held(lambda t: spark.table(f"{name}.{t}")) == OLD
    target.publish({"dim": spark.range(2), "fact": spark.range(1)})  # other columns
    assert spark.table(f"{name}.dim").columns == ["id"] and spark.table(f"{name}.dim").count() == 2


def test_schemas_cast_what_is_written(spark, tmp_path):
    target = Warehouse(spark, str(tmp_path))
    target.publish({"t": spark.range(2).selectExpr("cast(id as int) as a", "'x' as b")}, schemas={"t": "b STRING, a BIGINT"})
    assert target.read("t").dtypes == [("b", "string"), ("a", "bigint")]


def test_new_keys_get_ids_above_the_stored_ones(spark):
    stored = spark.createDataFrame([(1, "b@x", "B"), (2, "d@x", "D"), (7, None, "none")], "id long, email string, name string")
    new = spark.createDataFrame(
        [(1, "a@x", "A"), (2, "B@x", "other B"), (3, "c@x", "C"), (4, None, "null again")], "id long, email string, name string"
    )
    got = stars.unseen_rows(stored, new, F.lower("email"), "id")
    assert sorted(map(tuple, got.collect())) == [(8, "a@x", "A"), (9, "c@x", "C")]
    assert stars.unseen_rows(stored.filter("false"), new, F.lower("email"), "id").count() == 4
    ids = stars.matched_ids(new, stored, F.lower("email"), "id")
    assert sorted(map(tuple, ids.collect())) == [(2, 1), (4, 7)]


@pytest.mark.parametrize("stop", [0, 2, 3])
def test_an_append_stopped_after_any_table_is_completed_by_the_next(spark, monkeypatch, stop, small):
    from starwash.plans import order_warehouse as warehouse
    from starwash.workload.views import dirty

    orders = warehouse.clean(dirty(spark, small, "orders_raw", order="ord"), "ord")

    def star_of(part):
        dimensions = warehouse.build_dimensions(part, "ord")
        return {**dimensions, "fact_sales": warehouse.fact_sales(part, dimensions).dropna(subset=warehouse.FACT)}

    name = f"app_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    early = (F.dayofmonth("order_date") == 1) & (F.length("product_key") % 2 == 0)
    warehouse.load_star(spark, star_of(orders.filter(early)), name)
    later, calls, write = star_of(orders.filter(~early)), itertools.count(), warehouse.write_table
    with monkeypatch.context() as patch:
        def guarded(*args, **kwargs):
            if next(calls) == stop:
                raise Stopped
            return write(*args, **kwargs)
        patch.setattr(warehouse, "write_table", guarded)
        with pytest.raises(Stopped):
            warehouse.append_star(spark, later, name)
    warehouse.append_star(spark, later, name)
    assert set(warehouse.append_star(spark, later, name).values()) == {0}
    tables = {t: spark.table(f"{name}.{t}") for t in warehouse.WAREHOUSE}
    warehouse.check_star(tables)
    assert tables["dim_customer"].count() == orders.select("email_key").distinct().count()
    assert tables["fact_sales"].count() == orders.filter("unit_price is not null and quantity is not null").count()
