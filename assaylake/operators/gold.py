"""Business tables: customer view, product catalogue, sales per group, executive summary."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.columns import exact_mean, instant, mean_of
from assaylake.operators.lineage import gold_enrich

MONEY = "decimal(18,2)"


def _money_sum(column: str) -> Column:
    """Exact, so that the result does not depend on the order of partitions."""
    return F.sum(F.col(f"`{column}`").cast(MONEY))


def engagement_tier(transactions: Column) -> Column:
    return F.when(transactions >= 5, "high").when(transactions >= 2, "medium").otherwise("low")


def customer_360(
    customers: DataFrame,
    transactions: DataFrame,
    *,
    key: str,
    amount: str,
    date: str,
    transaction_key: str | None = None,
    carry: Sequence[str] | None = None,
    fill_zero: bool = False,
    gold_table: str | None = None,
    processed_at: str | dt.datetime | None = None,
) -> DataFrame:
    """Customers with their transaction metrics and engagement tier.

    Transactions are aggregated before the join, so a customer with very many of them costs one joined row.
    ``fill_zero`` gives customers without transactions zeros instead of NULL.
    """
    other = transaction_key or key
    total, count = _money_sum(amount), F.count(F.lit(1))
    metrics = (
        transactions.groupBy(F.col(f"`{other}`").alias("__key"))
        .agg(
            count.alias("total_transactions"),
            total.cast("double").alias("total_spend"),
            mean_of(total, F.count(F.col(f"`{amount}`"))).alias("avg_transaction_amount"),
            F.max(date).alias("last_transaction_date"),
            F.min(date).alias("first_transaction_date"),
        )
        .where(F.col("__key").isNotNull())
    )
    names = list(carry) if carry is not None else [c for c in customers.columns if c not in ("_dq", "_lineage")]
    kept = [c for c in ("_dq", "_lineage") if c in customers.columns]

    def measure(name: str, zero: object) -> Column:
        return (F.coalesce(F.col(name), F.lit(zero)) if fill_zero else F.col(name)).alias(name)

    joined = customers.join(metrics, F.col(f"`{key}`") == F.col("__key"), "left").select(
        *[F.col(f"`{c}`") for c in names],
        measure("total_transactions", 0),
        measure("total_spend", 0.0),
        measure("avg_transaction_amount", 0.0),
        "last_transaction_date",
        "first_transaction_date",
        engagement_tier(F.col("total_transactions")).alias("engagement_tier"),
        *kept,
        instant(processed_at).alias("_gold_processed_at"),
    )
    return gold_enrich(joined, gold_table, processed_at) if gold_table else joined


def engagement_distribution(customer_view: DataFrame) -> DataFrame:
    """Customers and mean spend per tier."""
    return customer_view.groupBy("engagement_tier").agg(
        F.count(F.lit(1)).alias("customer_count"),
        exact_mean("total_spend").alias("avg_spend"),
    )


def product_catalog(
    products: DataFrame,
    *,
    columns: Sequence[str],
    price: str,
    gold_table: str | None = None,
    processed_at: str | dt.datetime | None = None,
) -> DataFrame:
    """Products with a rounded unit price."""
    kept = [c for c in ("_dq", "_lineage") if c in products.columns]
    selected = products.select(
        *[F.col(f"`{c}`") for c in columns],
        F.round(F.col(f"`{price}`"), 2).alias("unit_price"),
        *kept,
        instant(processed_at).alias("_gold_processed_at"),
    )
    return gold_enrich(selected, gold_table, processed_at) if gold_table else selected


def sales_metrics(transactions: DataFrame, *, group: str, amount: str, quantity: str) -> DataFrame:
    """Orders, revenue, mean order value and units per group (merchant, brand, ...)."""
    revenue = _money_sum(amount)
    return transactions.groupBy(F.col(f"`{group}`")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        revenue.cast("double").alias("total_revenue"),
        mean_of(revenue, F.count(F.col(f"`{amount}`"))).alias("avg_order_value"),
        _money_sum(quantity).cast("double").alias("total_units_sold"),
    )


def sales_metrics_by(
    transactions: DataFrame, lookup: DataFrame, *, key: str, of: str, group: str, amount: str, quantity: str
) -> DataFrame:
    """:func:`sales_metrics` by a column of a looked-up table (``lookup`` with its key ``of``): lines are summed per key,
    and only sums are joined, so a much-sold key is one row and the shuffle of lines combines first."""
    sums = transactions.groupBy(F.col(f"`{key}`").alias("__key")).agg(
        F.count(F.lit(1)).alias("__lines"),
        F.count(F.col(f"`{amount}`")).alias("__amounts"),
        _money_sum(amount).alias("__revenue"),
        _money_sum(quantity).alias("__units"),
    )
    named = sums.join(lookup.select(F.col(f"`{of}`").alias("__of"), F.col(f"`{group}`")), F.col("__key") == F.col("__of"))
    revenue = F.sum("__revenue")
    return named.groupBy(F.col(f"`{group}`")).agg(
        F.sum("__lines").alias("total_orders"),
        revenue.cast("double").alias("total_revenue"),
        mean_of(revenue, F.sum("__amounts")).alias("avg_order_value"),
        F.sum("__units").cast("double").alias("total_units_sold"),
    )


def top_sellers(sales: DataFrame, group: str, k: int = 1) -> DataFrame:
    """The groups with the greatest revenue; ties go to the smaller name."""
    return sales.orderBy(F.desc("total_revenue"), F.asc(group)).limit(k)


def executive_summary(scores: DataFrame, processed_at: str | dt.datetime | None = None) -> DataFrame:
    return scores.select(
        "dataset_name",
        "overall_dq_score",
        "total_rules",
        "rules_passed",
        "rules_failed",
        "rules_errored",
        "total_records_in",
        "total_records_out",
        "records_quarantined",
        "run_id",
        "scored_at",
        instant(processed_at).alias("_gold_processed_at"),
    )
