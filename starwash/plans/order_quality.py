"""E-commerce data quality: complete, standardise, deduplicate, validate, cap, time, report.

Only exact duplicates are dropped; everything else that is changed or doubtful carries a flag.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starwash.functions.dates import (
    IMPUTED_LABELS, date_text, hours_between, is_late, resolve_ambiguous_date,
)
from starwash.functions.numeric import round_half_even
from starwash.functions.rules import (
    GENDER_RULES, ORDER_STATUSES, PAYMENT_RULES, STATUS_RULES, amount_mismatch, differs_from, expected_amount,
    in_set, invalid_quantity, not_in_set, placeholder_email, standardize,
)
from starwash.operators.checks import (
    Expectation, expect_between, expect_in_set, expect_not_null, expect_within,
)
from starwash.operators.dedupe import drop_exact_duplicates
from starwash.operators.fill import fill_constant, flag_missing
from starwash.operators.outliers import (
    FLAG as OUTLIER_FLAG, bounds_of_regular_sales, cap_outliers, changed, flag_outliers,
)
from starwash.sources.csv import write_csv
from starwash.sources.staging import stage

AMOUNT = "Transaction_Amount"
BEFORE = "Transaction_Amount_Before_Capping"
PROMOTION = "Is_Promotion"
N_EQUAL = "_n_equal"


def complete(df: DataFrame) -> DataFrame:
    """Flag missing e-mails and provinces, then fill them so that no sale is lost."""
    flagged = flag_missing(df, {
        "Customer_Email_Was_Missing": "Customer_Email", "Province_Was_Missing": "Province",
    })
    email = placeholder_email(F.col("Customer_Email"), F.col("Customer_ID"))
    return fill_constant(flagged.withColumn("Customer_Email", email), {"Province": "Unknown"})


def standardize_categories(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "Gender": standardize(F.col("Gender"), GENDER_RULES),
        "Payment_Method": standardize(F.col("Payment_Method"), PAYMENT_RULES),
    })


def resolve_order_dates(df: DataFrame) -> DataFrame:
    """Order_Date as ISO text, how it was read, and whether the load date or a guess was needed."""
    loaded = df.withColumn("Load_Timestamp", F.to_timestamp_ntz(F.col("Load_Timestamp")))
    load_date = F.to_date("Load_Timestamp")
    read = resolve_ambiguous_date(loaded, "Order_Date", load_date, "_date", "Order_Date_Parse_Method")
    return read.withColumns({
        "Order_Date": date_text(F.coalesce("_date", load_date)),
        "Order_Date_Was_Imputed": in_set(F.col("Order_Date_Parse_Method"), IMPUTED_LABELS),
    }).drop("_date")


def check_validity(df: DataFrame) -> DataFrame:
    """Quantity, amount and order-status flags; the status is standardised, other values stay.

    The amount is held against the exact product, not against the rounded Expected_Amount. A sale without
    promotion mark counts as regular, here and in ``expectations``.
    """
    expected = expected_amount(F.col("Quantity"), F.col("Unit_Price"), F.col("Discount_Rate"))
    return df.withColumns({
        "Quantity_Was_Invalid": invalid_quantity(F.col("Quantity")),
        "Expected_Amount": round_half_even(expected),
        "Accuracy_Flag": amount_mismatch(F.col(AMOUNT), expected, F.col(PROMOTION)),
        "Order_Status_Was_Invalid": not_in_set(F.col("Order_Status"), ORDER_STATUSES),
        "Order_Status": standardize(F.col("Order_Status"), STATUS_RULES),
    })


def measure_load_delay(df: DataFrame) -> DataFrame:
    delay = hours_between(F.col("Order_Date"), F.col("Load_Timestamp"))
    return df.withColumn("Load_Delay_Hours", delay).withColumn(
        "Is_Late_Load", is_late(F.col("Load_Delay_Hours"))
    )


def late_summary(df: DataFrame) -> DataFrame:
    n, late = F.count(F.lit(1)), F.count_if("Is_Late_Load")
    return df.agg(
        n.alias("n_rows"), late.alias("n_late"), round_half_even(late / n * 100).alias("late_pct")
    )


def standardized(raw: DataFrame) -> DataFrame:
    return raw.transform(complete).transform(standardize_categories).transform(resolve_order_dates)


def clean(raw: DataFrame) -> DataFrame:
    """The whole chain. Deduplicated rows are staged: the fences and the result both read them."""
    unique = stage(raw.transform(standardized).transform(drop_exact_duplicates))
    bounds = stage(bounds_of_regular_sales(unique, AMOUNT, PROMOTION))
    flagged = flag_outliers(check_validity(unique), bounds, AMOUNT, PROMOTION).drop("Promo_Outside_Bounds")
    capped = cap_outliers(flagged, bounds, AMOUNT, PROMOTION, before=BEFORE)
    return measure_load_delay(capped)


def quality_report(raw: DataFrame, final: DataFrame) -> DataFrame:
    """Ten metrics before and after cleaning.

    Row counts, missing values and copies before cleaning come from ``raw``; the metrics of the later
    steps are counted on deduplicated rows. Either table is read once: equal rows collapse to one with
    their number, and all metrics are sums over those.
    """
    # The metric names and notes of the published report, in its order.
    names = [
        "Total rows",
        "Missing Customer_Email",
        "Missing Province",
        "Exact duplicate rows",
        "Invalid / unparseable Order_Date (needed fallback or assumption)",
        "Invalid Quantity (outside 1-20)",
        "Mismatched Transaction_Amount (Accuracy_Flag, diff > 1 THB)",
        "Outliers capped (Transaction_Amount, non-promo)",
        "Late loads (> 24 hours)",
        "Invalid Order_Status (raw values outside standard set)",
    ]
    rows, email, province, copies, dates, quantities, amounts, outliers, late, statuses = range(10)
    nothing, n = F.lit(None).cast("bigint"), F.col(N_EQUAL)

    def n_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    def n_null(name: str) -> Column:
        return n_where(F.col(name).isNull())

    def measured(df: DataFrame, values: dict[int, tuple[Column, Column]]) -> DataFrame:
        """Metric rows ``(position, before, after)`` from one aggregate over the distinct rows of ``df``."""
        distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(N_EQUAL))
        pairs = distinct.agg(*[F.struct(b.alias("before"), a.cast("string").alias("after")).alias(f"_{i}")
                               for i, (b, a) in values.items()])
        cells = [F.struct(F.lit(i).alias("position"), F.col(f"_{i}.before"), F.col(f"_{i}.after")) for i in values]
        return pairs.select(F.inline(F.array(*cells)))

    outside = not_in_set(F.col("Order_Status"), ORDER_STATUSES)
    capped = changed(F.col(AMOUNT), F.col(BEFORE))
    n_rows, n_copies = n_where(F.lit(True)), F.coalesce(F.sum(n - 1), F.lit(0))
    parts = [
        measured(raw, {
            rows: (n_rows, nothing),
            email: (n_null("Customer_Email"), nothing),
            province: (n_null("Province"), nothing),
            copies: (n_copies, nothing),
        }),
        measured(final, {
            rows: (nothing, n_rows),
            email: (nothing, n_null("Customer_Email")),
            province: (nothing, n_null("Province")),
            copies: (nothing, n_copies),
            dates: (n_where(F.col("Order_Date_Was_Imputed")), F.lit("N/A (flag preserved for audit)")),
            quantities: (n_where(F.col("Quantity_Was_Invalid")), F.lit("N/A (flag preserved, not deleted)")),
            amounts: (n_where(F.col("Accuracy_Flag")), F.lit("N/A (flag preserved, promo rows untouched)")),
            outliers: (n_where(F.col(OUTLIER_FLAG)), n_where(capped)),
            late: (n_where(F.col("Is_Late_Load")), F.lit("N/A (informational, rows kept)")),
            statuses: (n_where(F.col("Order_Status_Was_Invalid")), n_where(outside)),
        }),
    ]
    merged = reduce(DataFrame.unionByName, parts).groupBy("position").agg(
        F.max("before").alias("before_cleaning"), F.max("after").alias("after_cleaning")
    )
    metric = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("position") + 1)
    return merged.orderBy("position").select(metric.alias("metric"), "before_cleaning", "after_cleaning")


def expectations() -> list[Expectation]:
    """Rules that the cleaned table should meet."""
    regular = differs_from(F.col(PROMOTION), "Y")
    exact = expected_amount(F.col("Quantity"), F.col("Unit_Price"), F.col("Discount_Rate"))
    return [
        *[expect_not_null(c) for c in ("Transaction_ID", "Customer_ID", AMOUNT)],
        expect_between("Quantity", 1, 20),
        expect_in_set("Gender", [*GENDER_RULES, "Unknown"]),
        expect_in_set("Payment_Method", [*PAYMENT_RULES, "Unknown"]),
        expect_in_set("Order_Status", ORDER_STATUSES),
        expect_within(AMOUNT, exact, 1.0, applies=regular),
    ]


def export(clean_orders: DataFrame, report: DataFrame, path: str) -> None:
    """Clean table (without the helper column) and quality report as CSV under ``path``."""
    root = path.rstrip("/")
    write_csv(clean_orders, f"{root}/e_commerce_clean", drop=[BEFORE])
    write_csv(report, f"{root}/data_quality_report")
