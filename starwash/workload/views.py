"""Dirty input views over the clean driver tables.

The driver tables have no dirt, so each view derives it by plain arithmetic. One expression text
serves both SQL dialects; only date formatting and adding hours differ. A view reads and joins just
the tables that the asked-for columns need.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from starwash.operators.ordering import with_ordinal

# Date formats as (Spark, DuckDB).
FORMATS = {
    "ISO": ("yyyy-MM-dd", "%Y-%m-%d"),
    "MON": ("dd-MMM-yyyy", "%d-%b-%Y"),
    "DMY": ("dd/MM/yyyy", "%d/%m/%Y"),
    "MDY": ("MM/dd/yyyy", "%m/%d/%Y"),
    "YSL": ("yyyy/MM/dd", "%Y/%m/%d"),
    "TS": ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
}
LINEITEM_ORDER = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


@dataclass(frozen=True)
class Dialect:
    spark: bool

    def fmt(self, name: str, x: str) -> str:
        spark_format, duck_format = FORMATS[name]
        return f"date_format({x}, '{spark_format}')" if self.spark else f"strftime({x}, '{duck_format}')"

    def plus_hours(self, x: str, hours: str) -> str:
        if self.spark:
            return f"{x} + make_dt_interval(0, cast({hours} as int), 0, 0)"
        return f"{x} + to_hours(cast({hours} as integer))"


SPARK, DUCK = Dialect(True), Dialect(False)


def _str(x: str) -> str:
    return f"cast({x} as string)"


def _dec(x: str) -> str:
    return _str(f"cast({x} as decimal(12,2))")


def _money(x: str) -> str:
    thousands = f"floor({x}/1000)"
    rest = f"lpad({_dec(f'{x} - {thousands}*1000')}, 6, '0')"
    return (
        f"case when {x} >= 1000 then concat('$', {_str(f'cast({thousands} as bigint)')}, ',', {rest}) "
        f"else {_dec(x)} end"
    )


_LINE = "k"
_LINEITEM = "(select *, l_orderkey*10 + l_linenumber as k from lineitem) as numbered"
_PRODUCT = f"case when {_LINE} % 2 = 0 then upper(p_name) else concat(' ', p_name) end"
_CATEGORY = "case when l_partkey % 5 = 0 then null else p_type end"
_BRANCH = (
    f"case when {_LINE} % 3 = 0 then lower(n_name) when {_LINE} % 3 = 1 then concat('  ', n_name, '  ') "
    "else n_name end"
)


def _sales_columns(d: Dialect) -> dict[str, tuple[str, set[str]]]:
    k = _LINE
    return {
        "Sale_ID": (f"concat(' S-', {_str('l_orderkey')}, '-', {_str('l_linenumber')}, ' ')", set()),
        "Store_Code": (f"concat('ST', lpad({_str('c_nationkey')}, 2, '0'))", {"customer"}),
        "Branch": (_BRANCH, {"nation"}),
        "Province": ("n_name", {"nation"}),
        "Region": (
            f"case when {k} % 7 = 0 then null when {k} % 11 = 0 then '   ' else r_name end", {"region"}
        ),
        "Product_Name": (_PRODUCT, {"part"}),
        "Category": (_CATEGORY, {"part"}),
        "Sale_Date": (
            f"case when {k} % 53 = 0 then 'not_a_date' when {k} % 113 = 0 then '0000-01-05' "
            f"when {k} % 3 = 0 then {d.fmt('ISO', 'l_shipdate')} "
            f"when {k} % 3 = 1 then {d.fmt('MON', 'l_shipdate')} else {d.fmt('DMY', 'l_shipdate')} end",
            set(),
        ),
        "Quantity": (
            f"case when {k} % 61 = 0 then 'n/a' when {k} % 59 = 0 then '2.5' when {k} % 127 = 0 then 'inf' "
            f"when {k} % 131 = 0 then '1e400' else {_str('cast(l_quantity as bigint)')} end",
            set(),
        ),
        "Unit_Price": (f"case when {k} % 67 = 0 then '' else {_dec('p_retailprice')} end", {"part"}),
        "Discount_Percent": (
            f"case when {k} % 13 = 0 then null "
            f"else {_str('cast(round(abs(l_discount)*100) as bigint)')} end",
            set(),
        ),
    }


def _orders_columns(d: Dialect) -> dict[str, tuple[str, set[str]]]:
    k = _LINE
    return {
        "Order_ID": (
            f"case when {k} % 59 = 0 then null "
            f"else concat('O-', {_str('l_orderkey')}, '-', {_str('l_linenumber')}) end",
            set(),
        ),
        "Customer_Name": (
            f"case when {k} % 3 = 0 then lower(c_name) else concat(' ', c_name) end", {"customer"}
        ),
        "Email": (
            f"case when {k} % 37 = 0 then null "
            f"when {k} % 2 = 0 then concat(' Cust', {_str('c_custkey')}, '@Example.COM ') "
            f"else concat('cust', {_str('c_custkey')}, '@example.com') end",
            {"customer"},
        ),
        "Product": (_PRODUCT, {"part"}),
        "Category": (_CATEGORY, {"part"}),
        "Order_Date": (
            f"case when {k} % 53 = 0 then 'not_a_date' when {k} % 113 = 0 then '05-01-0000' "
            f"when {k} % 2 = 0 then {d.fmt('ISO', 'l_shipdate')} "
            f"else {d.fmt('DMY', 'l_shipdate')} end",
            set(),
        ),
        "Quantity": (f"case when {k} % 61 = 0 then '2.5' else {_str('cast(l_quantity as bigint)')} end", set()),
        "Unit_Price": (
            f"case when {k} % 67 = 0 then 'Rs. 500' when {k} % 71 = 0 then '(100.50)' when {k} % 73 = 0 then '1e3' "
            f"when {k} % 79 = 0 then '2 for 100' when {k} % 83 = 0 then '1.234,50' "
            f"when {k} % 89 = 0 then '-12.50 EUR' else {_money('p_retailprice')} end",
            {"part"},
        ),
        "Amount": (f"case when {k} % 4 = 0 then null else {_money('round(l_extendedprice, 2)')} end", set()),
    }


def _ecom_columns(d: Dialect) -> dict[str, tuple[str, set[str]]]:
    o = "o_orderkey"
    quantity = f"({o} % 20 + 1)"
    rate = f"({o} % 4 * 5 / 100.0e0)"
    return {
        "Transaction_ID": (f"concat('T', {_str(o)})", set()),
        "Customer_ID": (f"concat('C', lpad({_str('c_custkey')}, 9, '0'))", {"customer"}),
        "Customer_Name": (f"case when {o} % 41 = 0 then upper(c_name) else c_name end", {"customer"}),
        "Customer_Email": (
            f"case when {o} % 12 = 0 then null else concat('c', {_str('c_custkey')}, '@shop.example') end",
            {"customer"},
        ),
        "Gender": (
            f"case when {o} % 50 = 0 then null when {o} % 5 = 0 then 'M' when {o} % 5 = 1 then 'male' "
            f"when {o} % 5 = 2 then ' FEMALE ' when {o} % 5 = 3 then 'f' else 'x' end",
            set(),
        ),
        "Payment_Method": (
            f"case {o} % 6 when 0 then 'cc' when 1 then 'Credit Card' when 2 then 'PromptPay' "
            f"when 3 then ' COD ' when 4 then 'bank_transfer' else 'crypto' end",
            set(),
        ),
        "Province": (f"case when {o} % 53 = 0 then null else n_name end", {"nation"}),
        "Is_Promotion": (
            f"case when {o} % 17 = 0 then null when {o} % 6 = 0 then 'Y' else 'N' end", set()
        ),
        "Transaction_Amount": (
            f"case when {o} % 97 = 0 then o_totalprice*100 when {o} % 89 = 0 then -o_totalprice "
            f"when {o} % 83 = 0 then null else o_totalprice end",
            set(),
        ),
        "Quantity": (f"case when {o} % 71 = 0 then -3 when {o} % 73 = 0 then 99 else {quantity} end", set()),
        "Unit_Price": (f"floor(o_totalprice / ({quantity} * (1 - {rate})) * 100) / 100.0e0", set()),
        "Discount_Rate": (rate, set()),
        "Order_Date": (
            f"case when {o} % 101 = 0 then 'not_a_date' when {o} % 109 = 0 then '05/01/0000' when {o} % 103 = 0 then '2026-13-05' "
            f"when {o} % 107 = 0 then '31/02/2026' when {o} % 4 = 0 then {d.fmt('ISO', 'o_orderdate')} "
            f"when {o} % 4 = 1 then {d.fmt('YSL', 'o_orderdate')} "
            f"when {o} % 4 = 2 then {d.fmt('DMY', 'o_orderdate')} else {d.fmt('MDY', 'o_orderdate')} end",
            set(),
        ),
        "Load_Timestamp": (
            d.fmt("TS", d.plus_hours("o_orderdate", f"({o}*7 + 1) % 48")), set()
        ),
        "Order_Status": (
            f"case {o} % 9 when 0 then 'done' when 1 then 'Cancel' when 2 then 'unknown_status' "
            "when 3 then 'Completed' when 4 then 'Completed' when 5 then 'Processing' "
            "when 6 then 'Processing' else 'Returned' end",
            set(),
        ),
    }


# Table a column needs -> the joins that bring it in, in order.
_LINE_JOINS = {
    "orders": "left join orders on l_orderkey = o_orderkey",
    "customer": "left join customer on o_custkey = c_custkey",
    "nation": "left join nation on c_nationkey = n_nationkey",
    "region": "left join region on n_regionkey = r_regionkey",
    "part": "left join part on l_partkey = p_partkey",
}
_ORDER_JOINS = {
    "customer": "left join customer on o_custkey = c_custkey",
    "nation": "left join nation on c_nationkey = n_nationkey",
}
_LEADS_TO = {"region": {"nation"}, "nation": {"customer"}, "customer": {"orders"}}

VIEWS = {
    "sales": (_sales_columns, "lineitem", _LINEITEM, _LINE_JOINS),
    "orders_raw": (_orders_columns, "lineitem", _LINEITEM, _LINE_JOINS),
    "ecom": (_ecom_columns, "orders", "orders", _ORDER_JOINS),
}


def _joins(needed: set[str], available: dict[str, str]) -> list[str]:
    todo, wanted = list(needed), set(needed)
    while todo:
        for t in _LEADS_TO.get(todo.pop(), ()):
            if t not in wanted:
                wanted.add(t)
                todo.append(t)
    return [t for t in available if t in wanted]


def _joined(tables: Sequence[str], available: dict[str, str], d: Dialect) -> str:
    """The joins of ``tables``. What hangs on orders is joined to these first in Spark, so that the line items, of which
    there are more, are shuffled for orders and part only; the rows are the same, all are left joins along a chain."""
    chain = [t for t in tables if t != "part"]
    if not (d.spark and "orders" in chain and len(chain) > 1):
        return " ".join(available[t] for t in tables)
    head, condition = available["orders"].split(" on ")
    inner = " ".join(available[t] for t in chain if t != "orders")
    nested = f"{head.replace('join orders', 'join (select * from orders')} {inner}) as ordered on {condition}"
    return " ".join([nested, *[available[t] for t in tables if t == "part"]])


def columns_of(view: str) -> list[str]:
    return list(VIEWS[view][0](SPARK))


def _select(view: str, columns: Sequence[str], d: Dialect, extra: Sequence[str]) -> tuple[str, list[str]]:
    build, base, source, available = VIEWS[view]
    exprs = build(d)
    tables = _joins(set().union(*[exprs[c][1] for c in columns]), available)
    items = [f"{exprs[c][0]} as {c}" for c in columns] + list(extra)
    text = f"select {', '.join(items)} from {source} {_joined(tables, available, d)}"
    return text, [base, *tables]


def view_sql(view: str, columns: Sequence[str] | None = None, order: bool = False, copies: bool = False) -> str:
    """The view as DuckDB SQL; ``order`` adds the ordering columns of the base table."""
    names = list(columns or columns_of(view))
    text, _ = _select(view, names, DUCK, LINEITEM_ORDER if order else ())
    if copies:
        text = f"{text} union all {text} where o_orderkey % 31 = 0"
    return text


def dirty(
    spark: SparkSession,
    sf_dir: str,
    view: str,
    columns: Sequence[str] | None = None,
    order: str | None = None,
    copies: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The view as a DataFrame.

    ``order`` names a bigint column, the ordinal of the base row: the driver files have no row order, so the
    sorted row stands for it. ``copies`` adds exact duplicates, ``keep`` columns of the base table.
    """
    names = list(columns or columns_of(view))
    text, tables = _select(view, names, SPARK, [*([order] if order else []), *keep])
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    if order:
        used = [c for c in LINEITEM_ORDER if re.search(rf"\b{c}\b", text)]
        frames["lineitem"] = with_ordinal(
            frames["lineitem"].select(*LINEITEM_ORDER), order, *LINEITEM_ORDER, columns=used
        )
    # Each table becomes a named argument of the statement; nothing is registered in the session.
    named = re.sub(rf"\b(from|join) ({'|'.join(tables)})\b", r"\1 {\2}", text)
    out = spark.sql(named, **frames)
    if copies:
        out = out.unionAll(spark.sql(f"{named} where o_orderkey % 31 = 0", **frames))
    return out
