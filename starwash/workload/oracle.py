"""The queries again, as SQL for DuckDB over the same tables."""

from __future__ import annotations

from collections.abc import Sequence

from starwash.workload.views import LINEITEM_ORDER, columns_of, view_sql

# What a CSV reader takes for missing.
NULL_TOKENS = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)
ORDER = ", ".join(LINEITEM_ORDER)
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def squeeze(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g')"


def title(x: str) -> str:
    words = f"regexp_extract_all({x}, '[a-zA-Z]+|[^a-zA-Z]+')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || lower(w[2:])), '')"


def finite(x: str) -> str:
    return f"case when isfinite({x}) then {x} end"


def number(x: str) -> str:
    return f"case when regexp_matches({x}, '{NUMBER}') then " + finite(f"try_cast({x} as double)") + " end"


def money(x: str) -> str:
    """The amount is taken out of the text; what is left around it must be a sign, a symbol or a code."""
    inner = f"case when {x} like '(%)' then substr({x}, 2, length({x}) - 2) else trim({x}) end"
    amount = f"regexp_extract({inner}, '[0-9][0-9,]*([.][0-9]*)?|[.][0-9]+')"
    around = f"replace({inner}, {amount}, '#')"
    wanted = "[+-]? ?([$€£¥฿]|[A-Za-z]{1,3}[.]?)? ?[+-]?# ?([$€£¥฿]|[A-Za-z]{2,3})?"
    whole = f"split_part({amount}, '.', 1)"
    return (
        f"case when regexp_full_match({around}, '{wanted}') and not ({x} like '(%)' and regexp_matches({x}, '[+-]')) "
        f"and (regexp_full_match({whole}, '[0-9]*') or regexp_full_match({whole}, '[0-9]{{1,3}}(,[0-9]{{3}})+')) "
        f"then (case when {x} like '(%)' or {x} like '%-%' then -1 else 1 end) "
        f"* try_cast(replace({amount}, ',', '') as double) end"
    )


def _real_year(x: str) -> str:
    return f"(case when not regexp_matches({x}, '(^|[^0-9])0000([^0-9]|$)') then {x} end)"


def date3(x: str) -> str:
    x = _real_year(x)
    return (
        f"coalesce(try_strptime({x}, '%Y-%m-%d'), try_strptime({x}, '%d-%b-%Y'), "
        f"try_strptime({x}, '%d/%m/%Y'))::date"
    )


def flexible(x: str) -> str:
    x = _real_year(x)
    return (
        f"coalesce(try_strptime({x}, '%Y-%m-%d'), try_strptime({x}, '%Y/%m/%d'), "
        f"try_strptime({x}, '%d-%b-%Y'), try_strptime({x}, '%d/%m/%Y'), try_strptime({x}, '%d-%m-%Y'), "
        f"try_strptime({x}, '%b %d, %Y'))::date"
    )


def even2(x: str, digits: int = 2) -> str:
    return f"round_even({x}, {digits})"


def money_sum(x: str) -> str:
    return f"cast(round(sum({x})::decimal(38,6), 2) as double)"


def with_views(body: str, **views: str) -> str:
    """``views`` name CTEs by the text of each."""
    return "with " + ", ".join(f"{n} as ({t})" for n, t in views.items()) + " " + body


def sales(body: str, *columns: str, order: bool = False) -> str:
    return with_views(body, t=view_sql("sales", columns, order=order))


def raw_orders(body: str, *columns: str, order: bool = False) -> str:
    return with_views(body, t=view_sql("orders_raw", columns, order=order))


def ecom(body: str, *columns: str, copies: bool = True) -> str:
    return with_views(body, t=view_sql("ecom", columns, copies=copies))


# --- retail star -------------------------------------------------------------------------------

_CLEAN_TEXT_A = ", ".join(f"{title(squeeze(c))} as {c}" for c in ("Branch", "Province", "Region", "Product_Name", "Category"))

RETAIL = {
    "t": view_sql("sales", order=True),
    "typed": (
        f"select trim(Sale_ID) as Sale_ID, trim(Store_Code) as Store_Code, {_CLEAN_TEXT_A}, "
        f"{date3('Sale_Date')} as Sale_Date, {number('Quantity')} as Quantity, "
        f"{number('Unit_Price')} as Unit_Price, coalesce({number('Discount_Percent')}, 0.0::double) as Discount_Percent, "
        f"{ORDER} from t"
    ),
    "firsts": f"select * from typed qualify row_number() over (partition by Sale_ID order by {ORDER}) = 1",
    "known": (
        f"select Store_Code, Region as known from firsts where Region <> '' "
        f"qualify row_number() over (partition by Store_Code order by {ORDER}) = 1"
    ),
    "located": (
        "select f.* replace (coalesce(nullif(f.Region, ''), k.known) as Region) "
        "from firsts f left join known k on f.Store_Code = k.Store_Code"
    ),
    "clean": (
        f"select *, {even2('Quantity * Unit_Price * (1 - Discount_Percent / 100)')} as Total_Amount from located "
        "where Sale_Date is not null and Quantity is not null and Unit_Price is not null"
    ),
    "loc": (
        "select row_number() over (order by Store_Code) as Location_ID, Store_Code, Branch, Province, Region from "
        f"(select * from clean qualify row_number() over (partition by Store_Code order by {ORDER}) = 1)"
    ),
    "prod": (
        "select row_number() over (order by Product_Name) as Product_ID, Product_Name, Category from "
        f"(select * from clean qualify row_number() over (partition by Product_Name order by {ORDER}) = 1)"
    ),
    "dates": "select row_number() over (order by d) as Date_ID, d from (select distinct Sale_Date as d from clean)",
}


def retail(body: str) -> str:
    return with_views(body, **RETAIL)


# --- order warehouse ---------------------------------------------------------------------------


def _name(x: str) -> str:
    return title(f"nullif({squeeze(x)}, '')")


def _email(x: str) -> str:
    packed = rf"lower(regexp_replace({x}, '\s', '', 'g'))"
    return rf"case when regexp_full_match({packed}, '[^@\s]+@[^@\s]+\.[^@\s]+') then {packed} end"


WAREHOUSE = {
    "t": view_sql("orders_raw", order=True),
    "named": (
        f"select nullif({squeeze('Order_ID')}, '') as order_id, {_name('Customer_Name')} as customer_name, "
        f"{_email('Email')} as email, {_name('Product')} as product_name, {_name('Category')} as category, "
        f"{flexible('Order_Date')} as order_date, {number('Quantity')} as quantity, "
        f"{money('Unit_Price')} as unit_price, {money('Amount')} as known_amount, {ORDER} from t"
    ),
    "typed": (
        f"select *, lower(email) as email_key, lower(product_name) as product_key, "
        f"case when known_amount is null and quantity is not null and unit_price is not null "
        f"then {even2('quantity * unit_price')} else known_amount end as amount from named"
    ),
    "clean": (
        "select * from typed where order_id is not null and order_date is not null and email_key is not null "
        "and product_key is not null and amount is not null "
        f"qualify row_number() over (partition by order_id order by {ORDER}) = 1"
    ),
    "cust": (
        "select row_number() over (order by email_key) as customer_id, customer_name, email from "
        f"(select * from clean qualify row_number() over (partition by email_key order by {ORDER}) = 1)"
    ),
    "prod": (
        "select row_number() over (order by product_key) as product_id, product_name, "
        "coalesce(known, 'Uncategorized') as category from (select product_key, "
        f"first(product_name order by {ORDER}) as product_name, "
        f"first(category order by {ORDER}) filter (category is not null) as known from clean group by product_key)"
    ),
    "days": (
        "select row_number() over (order by d) as date_id, strftime(d, '%Y-%m-%d') as date, year(d) as year, "
        "quarter(d) as quarter, month(d) as month, monthname(d) as month_name, day(d) as day, "
        "dayname(d) as weekday_name from (select distinct order_date as d from clean)"
    ),
    "keyed": (
        "select c.*, cust.customer_id, prod.product_id, days.date_id from clean c "
        "left join cust on c.email_key = lower(cust.email) "
        "left join prod on c.product_key = lower(prod.product_name) "
        "left join days on strftime(c.order_date, '%Y-%m-%d') = days.date"
    ),
    "fact": (
        "select order_id, customer_id, product_id, date_id, cast(trunc(quantity) as bigint) as quantity, "
        "unit_price, amount from keyed "
        "where customer_id is not null and product_id is not null and date_id is not null"
    ),
}


def warehouse(body: str) -> str:
    return with_views(body, **WAREHOUSE)


# --- e-commerce quality ------------------------------------------------------------------------

# The synonyms, standard values and labels of the published rules.
_GENDER = (
    "case lower(trim(Gender)) when 'm' then 'M' when 'male' then 'M' when 'f' then 'F' when 'female' then 'F' "
    "else 'Unknown' end"
)
_PAYMENT = (
    "case when lower(trim(Payment_Method)) in ('cc', 'credit card', 'card') then 'Credit Card' "
    "when lower(trim(Payment_Method)) in ('pp', 'promptpay', 'prompt pay') then 'PromptPay' "
    "when lower(trim(Payment_Method)) in ('cod', 'cash on delivery', 'cash') then 'Cash on Delivery' "
    "when lower(trim(Payment_Method)) in ('transfer', 'bank transfer', 'bank_transfer') then 'Bank Transfer' "
    "else 'Unknown' end"
)
_STATUS = (
    "case lower(trim(Order_Status)) when 'done' then 'Completed' when 'completed' then 'Completed' "
    "when 'processing' then 'Processing' when 'cancel' then 'Cancelled' when 'cancelled' then 'Cancelled' "
    "when 'returned' then 'Returned' else 'Unknown' end"
)
_VALID_STATUS = "coalesce(Order_Status in ('Completed', 'Processing', 'Cancelled', 'Returned'), false)"
_EMAIL_FILL = "coalesce(Customer_Email, 'unknown_' || coalesce(Customer_ID, '') || '@unknown.local')"
_REGULAR = "Is_Promotion is distinct from 'Y'"
_EXACT = "Quantity * Unit_Price * (1 - Discount_Rate)"


def ambiguous(source: str) -> dict[str, str]:
    """CTEs that read ``Order_Date`` of ``source`` with the load date at hand; the last is ``dated``."""
    two = r"^(\d{1,2})[-/](\d{1,2})[-/](\d{4})$"
    part = {i: rf"nullif(try_cast(regexp_extract(trim(Order_Date), '{two}', {i}) as integer), 0)" for i in (1, 2, 3)}
    return {
        "pieces": (
            f"select *, cast(Load_Timestamp as timestamp)::date as load_date, "
            rf"case when regexp_matches(trim(Order_Date), '^\d{{4}}[-/]\d{{2}}[-/]\d{{2}}$') "
            f"then try_cast(replace(trim(Order_Date), '/', '-') as date) end as iso, "
            f"{part[1]} as a, {part[2]} as b, {part[3]} as y from {source}"
        ),
        "readings": (
            "select *, try_cast(printf('%04d-%02d-%02d', y, b, a) as date) as dmy, "
            "try_cast(printf('%04d-%02d-%02d', y, a, b) as date) as mdy from pieces"
        ),
        "labelled": (
            "select *, case when iso is not null then 'ISO_format' "
            "when a > 12 and dmy is not null then 'DD_MM_YYYY_unambiguous' "
            "when b > 12 and mdy is not null then 'MM_DD_YYYY_unambiguous' "
            "when a <= 12 and b <= 12 and dmy = load_date then 'DD_MM_YYYY_by_load_ts' "
            "when a <= 12 and b <= 12 and mdy = load_date then 'MM_DD_YYYY_by_load_ts' "
            "when a <= 12 and b <= 12 and dmy is not null then 'DD_MM_YYYY_default_assumption' "
            "else 'UNPARSEABLE' end as Order_Date_Parse_Method from readings"
        ),
        "dated": (
            "select * exclude (load_date, iso, a, b, y, dmy, mdy, Order_Date), "
            "strftime(case when Order_Date_Parse_Method = 'ISO_format' then iso "
            "when Order_Date_Parse_Method like 'DD%' then dmy when Order_Date_Parse_Method like 'MM%' then mdy "
            "else load_date end, '%Y-%m-%d') as Order_Date, "
            "Order_Date_Parse_Method in ('UNPARSEABLE', 'DD_MM_YYYY_by_load_ts', 'MM_DD_YYYY_by_load_ts', "
            "'DD_MM_YYYY_default_assumption') as Order_Date_Was_Imputed from labelled"
        ),
    }


_DELAY = "date_diff('second', cast(Order_Date as timestamp), cast(Load_Timestamp as timestamp)) / 3600.0::double"


def dated(body: str, copies: bool = True) -> str:
    view = view_sql("ecom", ["Transaction_ID", "Order_Date", "Load_Timestamp"], copies=copies)
    return with_views(body, t=view, **ambiguous("t"))


def bounds(source: str) -> dict[str, str]:
    return {
        "quarts": (
            "select quantile_cont(Transaction_Amount, 0.25) as q1, quantile_cont(Transaction_Amount, 0.75) as q3 "
            f"from {source} where {_REGULAR}"
        ),
        "bounds": (
            "select q1, q3, q3 - q1 as iqr, q1 - 1.5 * (q3 - q1) as lower_bound, q3 + 1.5 * (q3 - q1) as upper_bound "
            "from quarts"
        ),
    }


_OUTSIDE = "coalesce(Transaction_Amount < lower_bound or Transaction_Amount > upper_bound, false)"
_CAPPED = (
    f"case when Transaction_Amount is not null and {_REGULAR} "
    "then least(greatest(Transaction_Amount, lower_bound), upper_bound) else Transaction_Amount end"
)


def amounts(body: str) -> str:
    view = view_sql("ecom", ["Transaction_ID", "Is_Promotion", "Transaction_Amount"], copies=True)
    return with_views(body, t=view, **bounds("t"))


QUALITY = {
    "t": view_sql("ecom", copies=True),
    "filled": (
        f"select * replace ({_EMAIL_FILL} as Customer_Email, coalesce(Province, 'Unknown') as Province, "
        f"{_GENDER} as Gender, {_PAYMENT} as Payment_Method), Customer_Email is null as Customer_Email_Was_Missing, "
        "Province is null as Province_Was_Missing from t"
    ),
    **ambiguous("filled"),
    "uniq": "select distinct * from dated",
    **bounds("uniq"),
    "checked": (
        "select u.*, lower_bound, upper_bound, not coalesce(Quantity between 1 and 20, false) as Quantity_Was_Invalid, "
        f"{even2('Quantity * Unit_Price * (1 - Discount_Rate)')} as Expected_Amount, "
        f"not {_VALID_STATUS} as Order_Status_Was_Invalid from uniq u cross join bounds"
    ),
    "final": (
        f"select * exclude (lower_bound, upper_bound) replace ({_STATUS} as Order_Status, {_CAPPED} as Transaction_Amount), "
        f"coalesce(abs(Transaction_Amount - {_EXACT}) > 1, false) and {_REGULAR} as Accuracy_Flag, "
        f"{_OUTSIDE} and {_REGULAR} as Outlier_Flag_Before_Capping, "
        "Transaction_Amount as Transaction_Amount_Before_Capping, "
        f"{_DELAY} as Load_Delay_Hours, {_DELAY} > 24 as Is_Late_Load from checked"
    ),
}


def quality(body: str) -> str:
    return with_views(body, **QUALITY)


def _described_number(name: str, expr: str, source: str) -> str:
    return (
        f"select '{name}' as \"column\", count({expr}) as count, round(avg({expr}), 4) as mean, "
        f"round(stddev_samp({expr}), 4) as std, round(min({expr}), 4) as min, "
        f"round(quantile_cont({expr}, 0.25), 4) as q1, round(quantile_cont({expr}, 0.5), 4) as median, "
        f"round(quantile_cont({expr}, 0.75), 4) as q3, round(max({expr}), 4) as max from {source}"
    )


_NUMERIC_C = ["Transaction_Amount", "Quantity", "Unit_Price", "Discount_Rate"]
_TEXT_C = [c for c in columns_of("ecom") if c not in _NUMERIC_C]
_TYPES_C = {c: "string" for c in _TEXT_C} | {c: "double" for c in _NUMERIC_C} | {"Quantity": "bigint"}
_PROFILED = ["Gender", "Payment_Method", "Order_Status", "Is_Promotion", "Province"]


def _union(parts: Sequence[str]) -> str:
    return " union all ".join(parts)


def _describe_all() -> str:
    empty = "null::varchar as top, null::bigint as freq"
    numbers = [
        f"select \"column\", count, null::bigint as \"unique\", {empty}, mean, std, min, q1, median, q3, max "
        f"from ({_described_number(c, f'{c}::double', 't')})"
        for c in _NUMERIC_C
    ]
    texts = [
        f"select '{c}' as \"column\", sum(n)::bigint as count, count(*) as \"unique\", "
        f"first(v order by n desc, v) as top, max(n) as freq, null::double as mean, null::double as std, "
        f"null::double as min, null::double as q1, null::double as median, null::double as q3, null::double as max "
        f"from (select {c} as v, count(*) as n from t where {c} is not null group by {c})"
        for c in _TEXT_C
    ]
    return _union(numbers + texts)


def _boxplot(name: str, expr: str) -> str:
    return (
        f"select '{name}' as \"column\", round(min(v) filter (v between lo and hi), 4) as whisker_low, "
        "round(any_value(q1), 4) as q1, round(any_value(q2), 4) as median, round(any_value(q3), 4) as q3, "
        "round(max(v) filter (v between lo and hi), 4) as whisker_high, "
        "count(*) filter (not v between lo and hi) as n_outliers from "
        f"(select {expr} as v from capped where {expr} is not null) x, "
        "(select *, q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from "
        f"(select quantile_cont({expr}, 0.25) as q1, quantile_cont({expr}, 0.5) as q2, "
        f"quantile_cont({expr}, 0.75) as q3 from capped) q) f"
    )


def _orphans(key: str, table: str, dim_key: str, where: str) -> str:
    return (
        f"select '{key}' as foreign_key, {key} as key_value, count(*) as n_rows from lineitem "
        f"where not exists (select 1 from {table} where {dim_key} = {key} and {where}) group by {key}"
    )


def _rows(names: Sequence[str], text: str) -> str:
    return _union([text.format(c=c) for c in names])


_REPORT = [
    ("Total rows", "(select count(*) from t)", "(select count(*) from final)"),
    ("Missing Customer_Email", "(select count(*) from t where Customer_Email is null)",
     "(select count(*) from final where Customer_Email is null)"),
    ("Missing Province", "(select count(*) from t where Province is null)",
     "(select count(*) from final where Province is null)"),
    ("Exact duplicate rows", "(select count(*) from t) - (select count(*) from (select distinct * from t))",
     "(select count(*) from final) - (select count(*) from (select distinct * from final))"),
    ("Invalid / unparseable Order_Date (needed fallback or assumption)",
     "(select count(*) from final where Order_Date_Was_Imputed)", "'N/A (flag preserved for audit)'"),
    ("Invalid Quantity (outside 1-20)", "(select count(*) from final where Quantity_Was_Invalid)",
     "'N/A (flag preserved, not deleted)'"),
    ("Mismatched Transaction_Amount (Accuracy_Flag, diff > 1 THB)",
     "(select count(*) from final where Accuracy_Flag)", "'N/A (flag preserved, promo rows untouched)'"),
    ("Outliers capped (Transaction_Amount, non-promo)",
     "(select count(*) from final where Outlier_Flag_Before_Capping)",
     "(select count(*) from final where Transaction_Amount is distinct from Transaction_Amount_Before_Capping)"),
    ("Late loads (> 24 hours)", "(select count(*) from final where Is_Late_Load)", "'N/A (informational, rows kept)'"),
    ("Invalid Order_Status (raw values outside standard set)",
     "(select count(*) from final where Order_Status_Was_Invalid)",
     f"(select count(*) from final where not {_VALID_STATUS})"),
]

# Rule names and valid sets.
_EXPECT = [
    ("not_null", "Transaction_ID", "true", "Transaction_ID is null"),
    ("not_null", "Customer_ID", "true", "Customer_ID is null"),
    ("not_null", "Transaction_Amount", "true", "Transaction_Amount is null"),
    ("between", "Quantity", "true", "not coalesce(Quantity between 1 and 20, false)"),
    ("in_set", "Gender", "true", "not coalesce(Gender in ('M', 'F', 'Unknown'), false)"),
    ("in_set", "Payment_Method", "true",
     "not coalesce(Payment_Method in ('Credit Card', 'PromptPay', 'Cash on Delivery', 'Bank Transfer', 'Unknown'), false)"),
    ("in_set", "Order_Status", "true", f"not {_VALID_STATUS}"),
    ("within_threshold", "Transaction_Amount", _REGULAR,
     f"coalesce(abs(Transaction_Amount - {_EXACT}) > 1, false)"),
]
_ANY_BROKEN = " or ".join(f"({applies} and {failed})" for _, _, applies, failed in _EXPECT)

# Promised columns and keys: published name, and where this file has them.
_PROMISED_A = [
    ("Dim_Location", "Location_ID", "Location_ID", "loc"), ("Dim_Product", "Product_ID", "Product_ID", "prod"),
    ("Dim_Date", "Date_ID", "Date_ID", "dates"), ("Dim_Date", "Sale_Date", "d", "dates"),
    *[("Fact_Sales", c, c, "clean") for c in ("Sale_ID", "Quantity", "Unit_Price", "Total_Amount")],
]
_KEYS_A = [
    ("Dim_Location", "Location_ID", "Location_ID", "loc"), ("Dim_Location", "Store_Code", "Store_Code", "loc"),
    ("Dim_Product", "Product_ID", "Product_ID", "prod"), ("Dim_Product", "Product_Name", "Product_Name", "prod"),
    ("Dim_Date", "Date_ID", "Date_ID", "dates"), ("Dim_Date", "Sale_Date", "d", "dates"),
    ("Fact_Sales", "Sale_ID", "Sale_ID", "clean"),
]
_PROMISED_B = [
    ("dim_customer", "cust", ["customer_id", "customer_name", "email"], ["customer_id", "email"]),
    ("dim_product", "prod", ["product_id", "product_name", "category"], ["product_id", "product_name"]),
    ("dim_date", "days", ["date_id", "date"], ["date_id", "date"]),
]

_QTY_PRICE_DISCOUNT = ("Quantity", "Unit_Price", "Discount_Percent")

ORACLE: dict[str, str] = {
    "scan_all_text": sales(
        "select " + ", ".join(f"case when {c} not in ({NULL_TOKENS}) then {c} end as {c}" for c in columns_of("sales"))
        + " from t", *columns_of("sales"),
    ),
    "null_tokens": sales(
        "select Sale_ID, " + ", ".join(
            f"case when {c} not in ({NULL_TOKENS}) then {c} end as {c}" for c in ("Region", *_QTY_PRICE_DISCOUNT)
        ) + " from t", "Sale_ID", "Region", *_QTY_PRICE_DISCOUNT,
    ),
    "clean_text": sales(
        f"select trim(Sale_ID) as Sale_ID, trim(Store_Code) as Store_Code, {_CLEAN_TEXT_A} from t",
        "Sale_ID", "Store_Code", "Branch", "Province", "Region", "Product_Name", "Category",
    ),
    "parse_number": sales(
        f"select Sale_ID, {number('Quantity')} as Quantity, {number('Unit_Price')} as Unit_Price, "
        f"coalesce({number('Discount_Percent')}, 0.0::double) as Discount_Percent from t",
        "Sale_ID", *_QTY_PRICE_DISCOUNT,
    ),
    "parse_currency": raw_orders(
        f"select Order_ID, {money('Unit_Price')} as unit_price, {money('Amount')} as amount from t",
        "Order_ID", "Unit_Price", "Amount",
    ),
    "parse_dates_multi": sales(
        f"select Sale_ID, {date3('Sale_Date')} as three_formats, {flexible('Sale_Date')} as flexible from t",
        "Sale_ID", "Sale_Date",
    ),
    "parse_dates_ambiguous": dated(
        "select Transaction_ID, Order_Date, Order_Date_Parse_Method, Order_Date_Was_Imputed from dated", copies=False
    ),
    "net_amount": sales(
        "select Sale_ID, " + even2(
            f"({number('Quantity')}) * ({number('Unit_Price')}) * (1 - coalesce({number('Discount_Percent')}, 0) / 100)"
        ) + " as Total_Amount from t", "Sale_ID", *_QTY_PRICE_DISCOUNT,
    ),
    "impute_amount": raw_orders(
        f"select Order_ID, coalesce({money('Amount')}, "
        + even2(f"({number('Quantity')}) * {money('Unit_Price')}") + ") as amount from t",
        "Order_ID", "Quantity", "Unit_Price", "Amount",
    ),
    "helper_clean_text": raw_orders(f"select nullif({squeeze('Order_ID')}, '') as order_id from t", "Order_ID"),
    "helper_title_case": raw_orders(
        f"select {_name('Customer_Name')} as customer_name, {_name('Product')} as product_name, "
        f"{_name('Category')} as category from t", "Customer_Name", "Product", "Category",
    ),
    "helper_clean_email": raw_orders(f"select Order_ID, {_email('Email')} as email from t", "Order_ID", "Email"),
    "helper_normalize_key": raw_orders(
        f"select Order_ID, lower({_email('Email')}) as email_key, lower({_name('Product')}) as product_key from t",
        "Order_ID", "Email", "Product",
    ),
    "load_delay": dated(
        f"select Transaction_ID, {even2(_DELAY, 6)} as Load_Delay_Hours, {_DELAY} > 24 as Is_Late_Load from dated",
        copies=False,
    ),
    "late_summary": dated(
        f"select count(*) as n_rows, count(*) filter ({_DELAY} > 24) as n_late, "
        f"{even2(f'count(*) filter ({_DELAY} > 24) / count(*) * 100')} as late_pct from dated"
    ),
    "delay_stats": dated(_described_number("Load_Delay_Hours", f"({_DELAY})", "dated")),
    "missing_flags": ecom(
        f"select Transaction_ID, Customer_ID, {_EMAIL_FILL} as Customer_Email, coalesce(Province, 'Unknown') as Province, "
        "Customer_Email is null as Customer_Email_Was_Missing, Province is null as Province_Was_Missing from t",
        "Transaction_ID", "Customer_ID", "Customer_Email", "Province",
    ),
    "fill_email": ecom(
        f"select Transaction_ID, {_EMAIL_FILL} as Customer_Email from t",
        "Transaction_ID", "Customer_ID", "Customer_Email",
    ),
    "fill_constants": sales(
        "select Sale_ID, coalesce(Category, 'Uncategorized') as Category from t", "Sale_ID", "Category"
    ),
    "standardize_gender": ecom(f"select Transaction_ID, {_GENDER} as Gender from t", "Transaction_ID", "Gender"),
    "standardize_payment": ecom(
        f"select Transaction_ID, {_PAYMENT} as Payment_Method from t", "Transaction_ID", "Payment_Method"
    ),
    "standardize_status": ecom(
        f"select Transaction_ID, {_STATUS} as Order_Status, not {_VALID_STATUS} as Order_Status_Was_Invalid from t",
        "Transaction_ID", "Order_Status",
    ),
    "validity_in_set": ecom(
        "select Transaction_ID, coalesce(Gender in ('M', 'male'), false) as gender_in_set, "
        "not coalesce(Is_Promotion in ('Y', 'N'), false) as promotion_invalid from t",
        "Transaction_ID", "Gender", "Is_Promotion",
    ),
    "non_promo_filter": ecom(f"select * from t where {_REGULAR}", "Transaction_ID", "Is_Promotion", "Transaction_Amount"),
    "quantity_validity": ecom(
        "select Transaction_ID, Quantity, not coalesce(Quantity between 1 and 20, false) as Quantity_Was_Invalid from t",
        "Transaction_ID", "Quantity",
    ),
    "accuracy_flag": ecom(
        f"select Transaction_ID, {even2(_EXACT)} as Expected_Amount, coalesce(abs(Transaction_Amount - {_EXACT}) > 1, false) "
        f"and {_REGULAR} as Accuracy_Flag from t",
        "Transaction_ID", "Quantity", "Unit_Price", "Discount_Rate", "Transaction_Amount", "Is_Promotion",
    ),
    "drop_incomplete": retail(
        "select Sale_ID, Sale_Date, Quantity, Unit_Price from typed "
        "where Sale_Date is not null and Quantity is not null and Unit_Price is not null"
    ),
    "fill_region": with_views(
        "select Sale_ID, r.Store_Code, coalesce(nullif(Region, ''), known) as Region "
        "from r left join known on r.Store_Code = known.Store_Code",
        t=view_sql("sales", ["Sale_ID", "Store_Code", "Region"], order=True),
        r=f"select trim(Sale_ID) as Sale_ID, Store_Code, {title(squeeze('Region'))} as Region, {ORDER} from t",
        known=(
            "select Store_Code, Region as known from r where Region <> '' "
            f"qualify row_number() over (partition by Store_Code order by {ORDER}) = 1"
        ),
    ),
    "group_ffill_bfill": sales(
        "select Sale_ID, product_key, coalesce("
        f"last_value(Category ignore nulls) over (partition by product_key order by {ORDER} rows unbounded preceding), "
        f"first_value(Category ignore nulls) over (partition by product_key order by {ORDER} "
        "rows between current row and unbounded following)) as Category, l_partkey "
        "from (select *, lower(trim(Product_Name)) as product_key from t)",
        "Sale_ID", "Product_Name", "Category", order=True,
    ),
    "expectations": quality(_union([
        f"select '{rule}' as rule, '{c}' as \"column\", count(*) filter ({applies}) as n_checked, "
        f"count(*) filter ({applies} and {failed}) as n_failed, "
        f"count(*) filter ({applies} and {failed}) = 0 as passed from final"
        for rule, c, applies, failed in _EXPECT
    ])),
    "profile_schema": ecom(_union([
        f"select {i}::bigint as position, '{c}' as \"column\", '{_TYPES_C[c]}' as dtype, count({c}) as non_null_count, "
        f"count(*) as n_rows, {len(_TYPES_C)}::bigint as n_columns from t"
        for i, c in enumerate(columns_of("ecom"))
    ])),
    "profile_missing": ecom(
        "select \"column\", missing_count, " + even2("missing_count / n * 100") + " as missing_pct from ("
        + _rows(columns_of("ecom"), "select '{c}' as \"column\", count(*) - count({c}) as missing_count, count(*) as n from t")
        + ") where missing_count > 0"
    ),
    "profile_duplicates": ecom(
        "select (select count(*) from t) - (select count(*) from (select distinct * from t)) as duplicate_rows"
    ),
    "profile_distinct": ecom(
        _rows(_PROFILED, "select '{c}' as \"column\", count(distinct {c}) as n_distinct from t"), *_PROFILED
    ),
    "profile_values": ecom(
        _rows(_PROFILED, "select distinct '{c}' as \"column\", {c} as value from t where {c} is not null"), *_PROFILED
    ),
    "profile_describe": ecom(_describe_all()),
    "value_counts": ecom("select Gender as value, count(*) as n from t group by Gender", "Gender"),
    "dedupe_keep_first": sales(
        "select Sale_ID, Sale_Date, Quantity, Discount_Percent from t "
        f"qualify row_number() over (partition by Sale_ID order by {ORDER}) = 1",
        "Sale_ID", "Sale_Date", "Quantity", "Discount_Percent", order=True,
    ),
    "dedupe_exact": ecom("select distinct * from t"),
    "dup_key_count": sales("select count(*) - count(distinct Sale_ID) as duplicate_keys from t", "Sale_ID"),
    "repeated_sales": sales(
        "select Sale_ID, Sale_Date, Quantity from t qualify count(*) over (partition by Sale_ID) > 1",
        "Sale_ID", "Sale_Date", "Quantity",
    ),
    "near_dup_customers": ecom(
        "select distinct Customer_ID, Customer_Name, Customer_Email from t where Customer_Email in "
        "(select Customer_Email from t group by Customer_Email having count(distinct Customer_Name) > 1)",
        "Customer_ID", "Customer_Name", "Customer_Email",
    ),
    "iqr_bounds": amounts(
        "select round(q1, 4) as q1, round(q3, 4) as q3, round(iqr, 4) as iqr, "
        "round(lower_bound, 4) as lower_bound, round(upper_bound, 4) as upper_bound from bounds"
    ),
    "outlier_flags": amounts(
        f"select t.*, {_OUTSIDE} and {_REGULAR} as Outlier_Flag_Before_Capping, "
        f"{_OUTSIDE} and not ({_REGULAR}) as Promo_Outside_Bounds from t cross join bounds"
    ),
    "cap_outliers": amounts(
        f"select Transaction_ID, round({_CAPPED}, 4) as Transaction_Amount, "
        "round(Transaction_Amount, 4) as Transaction_Amount_Before_Capping, "
        f"{_CAPPED} is distinct from Transaction_Amount as was_capped from t cross join bounds"
    ),
    "boxplot_stats": with_views(
        _union([_boxplot("Transaction_Amount_Before_Capping", "before"), _boxplot("Transaction_Amount", "after")]),
        t=view_sql("ecom", ["Is_Promotion", "Transaction_Amount"], copies=True), **bounds("t"),
        capped=f"select Transaction_Amount as before, {_CAPPED} as after from t cross join bounds",
    ),
    "clean_sales_a": retail(
        "select Sale_ID, Store_Code, Branch, Province, Region, Product_Name, Category, Sale_Date, Quantity, Unit_Price, "
        "Discount_Percent, Total_Amount from clean"
    ),
    "surrogate_keys": sales(
        "select row_number() over (order by id) as Sale_Key, id as Sale_ID from (select distinct trim(Sale_ID) as id from t)",
        "Sale_ID",
    ),
    "dim_location": retail("select * from loc"),
    "dim_product_a": retail("select * from prod"),
    "fact_location_product": retail(
        "select Sale_ID, Location_ID, Product_ID from clean c left join loc on c.Store_Code = loc.Store_Code "
        "left join prod on c.Product_Name = prod.Product_Name"
    ),
    "fact_date_lookup": retail("select Sale_ID, Date_ID from clean left join dates on Sale_Date = d"),
    "fact_sales_a": retail(
        "select Sale_ID, Location_ID, Product_ID, Date_ID, Quantity, Unit_Price, "
        "Discount_Percent, Total_Amount from clean c left join loc on c.Store_Code = loc.Store_Code "
        "left join prod on c.Product_Name = prod.Product_Name left join dates on Sale_Date = d"
    ),
    "clean_sales_b": warehouse(
        "select order_id, customer_name, email, email_key, product_name, product_key, category, order_date, quantity, "
        "unit_price, amount from clean"
    ),
    "rejected_orders": warehouse(
        "select order_id, order_date, email_key, product_key, amount from typed where order_id is null "
        "or order_date is null or email_key is null or product_key is null or amount is null"
    ),
    "dim_generic": warehouse(
        "select row_number() over (order by category nulls last) as category_id, category, product_name from "
        f"(select * from clean qualify row_number() over (partition by category order by {ORDER}) = 1)"
    ),
    "dim_customer": warehouse("select * from cust"),
    "dim_product_b": warehouse("select * from prod"),
    "dim_date": warehouse("select * from days"),
    "fact_customer_key": warehouse("select order_id, customer_id from keyed"),
    "fact_product_key": warehouse("select order_id, product_id from keyed"),
    "fact_date_key": warehouse("select order_id, date_id from keyed"),
    "fact_projection": warehouse(
        "select order_id, customer_id, product_id, date_id, cast(trunc(quantity) as bigint) as quantity, unit_price, "
        "amount from keyed"
    ),
    "fact_sales_b": warehouse("select * from fact"),
    "fact_unmatched": warehouse(
        "select order_id, customer_id, product_id, date_id from typed c "
        "left join cust on c.email_key = lower(cust.email) left join prod on c.product_key = lower(prod.product_name) "
        "left join days on strftime(c.order_date, '%Y-%m-%d') = days.date "
        "where customer_id is null or product_id is null or date_id is null"
    ),
    "fk_orphans": _union([
        _orphans("l_orderkey", "orders", "o_orderkey", "o_orderstatus <> 'F'"),
        _orphans("l_partkey", "part", "p_partkey", "p_size > 5"),
        _orphans("l_suppkey", "supplier", "s_suppkey", "s_acctbal >= 0"),
    ]),
    "not_null_violations": warehouse(
        "select * from ("
        + _rows(
            ["order_id", "order_date", "email_key", "product_key", "amount", "customer_name", "category", "quantity",
             "unit_price"],
            "select '{c}' as \"column\", count(*) - count({c}) as n_null from typed",
        ) + ") where n_null > 0"
    ),
    "unique_violations": sales(
        "select trim(Sale_ID) as Sale_ID, count(*) as n_rows from t group by trim(Sale_ID) having count(*) > 1", "Sale_ID"
    ),
    "table_row_counts": warehouse(
        "select 'dim_customer' as table_name, count(*) as row_count from cust union all "
        "select 'dim_product', count(*) from prod union all select 'dim_date', count(*) from days union all "
        "select 'fact_sales', count(*) from fact"
    ),
    "table_row_counts_a": retail(
        "select 'Dim_Location' as table_name, count(*) as row_count from loc union all "
        "select 'Dim_Product', count(*) from prod union all select 'Dim_Date', count(*) from dates union all "
        "select 'Fact_Sales', count(*) from clean"
    ),
    "violations_a": retail(_union([
        f"select '{t}' as table_name, 'not_null' as rule, '{c}' as \"column\", count(*) - count({x}) as n_broken from {v}"
        for t, c, x, v in _PROMISED_A
    ] + [
        f"select '{t}', 'unique', '{c}', cast(count(*) - count(distinct {x}) as bigint) from {v}"
        for t, c, x, v in _KEYS_A
    ])),
    "dim_violations_b": warehouse(_union([
        f"select '{t}' as table_name, 'not_null' as rule, '{c}' as \"column\", count(*) - count({c}) as n_broken from {v}"
        for t, v, cs, _ in _PROMISED_B for c in cs
    ] + [
        f"select '{t}', 'unique', '{c}', cast(count(*) - count(distinct {c}) as bigint) from {v}"
        for t, v, _, ks in _PROMISED_B for c in ks
    ])),
    "cut_quantities": warehouse(
        "select count(quantity) as n_rows, count(*) filter (quantity <> floor(quantity)) as n_cut from clean"
    ),
    "scan_typed": ecom(
        "select Transaction_ID, Quantity, Transaction_Amount, Unit_Price from t",
        "Transaction_ID", "Quantity", "Transaction_Amount", "Unit_Price", copies=False,
    ),
    "csv_rejects": (
        "select o_orderkey % 10 as last_digit, count(*) as n_bad from orders where o_orderkey % 7 = 0 group by all"
    ),
    "clean_orders_from_csv": quality(
        "select Transaction_ID, Customer_Email, Order_Date, Order_Date_Parse_Method, Quantity, "
        "round(Transaction_Amount, 4) as Transaction_Amount, Accuracy_Flag, Is_Late_Load from final"
    ),
    "write_replace": "select c_mktsegment as segment, count(*) as n from customer group by all",
    "write_append_counts": (
        "select n, (select count(*) from nation) + (select count(*) from region) as total from "
        "(select count(*) as n from nation union all select count(*) from region)"
    ),
    "load_star_roundtrip": warehouse(
        "select p.category, count(*) as n_rows, sum(quantity)::bigint as total_quantity, "
        "(select count(*) from fact where unit_price is null) as n_left_out "
        "from fact join prod p using (product_id) where unit_price is not null group by p.category"
    ),
    "publish_roundtrip": (
        "with n as (select 'nation' as table_name, n_regionkey as r from nation union all select 'region', r_regionkey from region) "
        "select step, table_name, count(*) as n_rows from n, (values ('1 loaded', 99), ('2 refused', 99), ('3 written', 99), "
        "('4 published', 3)) as s(step, below) where r < below group by all"
    ),
    "append_dimensions": warehouse(_union([
        f"select '{t}' as table_name, count(distinct {k}) as n_rows, count(distinct {k}) as n_ids, "
        f"count(distinct {k}) filter (month(order_date) <= 6) as n_unchanged from {source}"
        for t, k, source in (
            ("dim_customer", "email_key", "clean"), ("dim_product", "product_key", "clean"), ("dim_date", "order_date", "clean"),
            ("fact_sales", "order_id", "(select * from clean where unit_price is not null)"),
        )
    ])),
    "scan_stray_quotes": (
        "select cast(o_orderkey as varchar) as key, case o_orderkey % 3 when 0 then 'pipe 5\" wide' when 1 then 'a \"b\", c' "
        "else o_orderpriority end as name, cast(o_custkey as varchar) as customer from orders"
    ),
    "scan_in_order": "select cast(n_nationkey as varchar) as key, n_name as name, true as alone from nation",
    "expectation_rejects": quality(
        "select * from (select Transaction_ID, concat_ws(';', "
        + ", ".join(f"case when {applies} and {failed} then '{rule}({c})' end" for rule, c, applies, failed in _EXPECT)
        + ") as reasons from final) where reasons <> ''"
    ),
    "expectation_counts": quality(_union([
        f"select '{rule}' as rule, '{c}' as \"column\", count(*) filter ({applies}) as n_checked, "
        f"count(*) filter ({applies} and {failed}) as n_failed, count(*) filter ({applies} and {failed}) = 0 as passed, "
        f"count(*) filter (not coalesce({_ANY_BROKEN}, false)) as n_accepted from final"
        for rule, c, applies, failed in _EXPECT
    ])),
    "extract_report": ecom(_union([
        f"select '{c}' as \"column\", '{_TYPES_C[c]}' as dtype, count(*) as n_rows, count({c}) as non_null_count, "
        f"count(*) - count({c}) as missing_count, count(distinct {c}) as n_distinct, "
        + (
            "cast(null as varchar) as top, cast(null as bigint) as freq, " if _TYPES_C[c] in ("bigint", "double", "int") else
            f"(select cast({c} as varchar) from t where {c} is not null group by {c} order by count(*) desc, cast({c} as varchar) limit 1) as top, "
            f"(select count(*) from t where {c} is not null group by {c} order by count(*) desc limit 1) as freq, "
        )
        + "(select count(*) from t) - (select count(*) from (select distinct * from t)) as duplicate_rows from t"
        for c in columns_of("ecom")
    ])),
    "export_roundtrip": quality(
        "select Transaction_ID, Customer_Email, Province, Gender, Payment_Method, Order_Date, Order_Status from final"
    ),
    "preview": (
        "select l_orderkey, l_linenumber, l_quantity from lineitem order by l_orderkey, l_linenumber, "
        "l_partkey, l_suppkey limit 5"
    ),
    "run_all_reports": warehouse(
        f"select 'sales_by_month' as report, count(*) as n_rows from (select distinct year, month from fact join days using (date_id)) "
        "union all select 'sales_by_product', count(*) from (select distinct product_name, category from fact join prod using (product_id)) "
        "union all select 'table_row_counts', 4 union all select 'total_sales', 1 "
        "union all select 'top_customer', least(10, (select count(distinct (customer_name, email)) from fact join cust using (customer_id))) "
        "union all select 'top_product', least(10, (select count(distinct product_name) from fact join prod using (product_id)))"
    ),
    "total_sales": warehouse(
        f"select {money_sum('amount')} as total_sales, sum(quantity)::bigint as total_quantity, "
        "count(*) as total_orders from fact"
    ),
    "sales_by_product": warehouse(
        f"select product_name, category, sum(quantity)::bigint as total_quantity, {money_sum('amount')} as total_sales "
        "from fact join prod using (product_id) group by product_name, category"
    ),
    "sales_by_month": warehouse(
        f"select year, month, month_name, {money_sum('amount')} as total_sales from fact join days using (date_id) "
        "group by year, month, month_name"
    ),
    "top_customer": warehouse(
        f"select customer_name, email, {money_sum('amount')} as total_sales from fact join cust using (customer_id) "
        "group by customer_name, email order by total_sales desc, customer_name, email limit 10"
    ),
    "top_product": warehouse(
        f"select product_name, {money_sum('amount')} as total_sales from fact join prod using (product_id) "
        "group by product_name order by total_sales desc, product_name limit 10"
    ),
    "clean_orders_c": quality(
        "select * replace (round(Transaction_Amount, 4) as Transaction_Amount, "
        "round(Transaction_Amount_Before_Capping, 4) as Transaction_Amount_Before_Capping, "
        "round(Load_Delay_Hours, 4) as Load_Delay_Hours) from final"
    ),
    "quality_report": quality(_union([
        f"select '{m}' as metric, ({b})::bigint as before_cleaning, cast(({a}) as varchar) as after_cleaning"
        for m, b, a in _REPORT
    ])),
}
