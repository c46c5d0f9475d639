"""Named quality rules: count violations, and drop the rows where asked.

A rule is a SQL predicate under a name. A row violates a rule when the
predicate is false or NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# The rules of the transaction and customer tables.
TRANSACTION_WARN = {"valid_transaction_amount": "amount > 0"}
TRANSACTION_DROP = {
    "valid_transaction_id": "transaction_id IS NOT NULL",
    "valid_customer_id": "customer_id IS NOT NULL",
    "valid_card_number": "card_number IS NOT NULL",
    "valid_merchant_id": "merchant_id IS NOT NULL",
    "valid_transaction_timestamp": "transaction_timestamp IS NOT NULL",
}
CUSTOMER_DROP = {"valid_customer_id": "customer_id IS NOT NULL"}

Rules = Mapping[str, str]

ROWS = "rows"


@dataclass(frozen=True)
class Expectation:
    """Rules under the name of their metric; `drop` says whether rows must meet them."""

    metric: str
    rules: Rules
    drop: bool = False


def _holds(predicate: str) -> Column:
    return F.coalesce(F.expr(predicate), F.lit(False))


def _counts(rules: Rules) -> list[Column]:
    failed = [F.count_if(~_holds(rule)).alias(name) for name, rule in rules.items()]
    return [F.count(F.lit(1)).alias(ROWS), *failed]


def expect_warn(df: DataFrame, rules: Rules, metric: str) -> DataFrame:
    """Keep every row; count the violations under `metric`.

    The counts come with the query's own pass over the data. A stream reports
    them in `observedMetrics` of its progress, per micro-batch.
    """
    return df.observe(metric, *_counts(rules))


def expect_drop(df: DataFrame, rules: Rules, metric: str | None = None) -> DataFrame:
    """Keep the rows that meet every rule; count the violations if named.

    Without a name the predicates stay free to move down into the file scan. Give
    one for columns that were just parsed out of a text: the counting keeps the
    predicates above the parse, which would otherwise run once more for each.
    """
    if metric is not None:
        df = df.observe(metric, *_counts(rules))
    for rule in rules.values():
        df = df.filter(F.expr(rule))
    return df


def rule_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows and violations of each rule, as one row, from one pass."""
    return df.agg(*_counts(rules))


def all_counts(expectations: Sequence[Expectation]) -> list[Column]:
    """Rows, and violations under `metric.rule`, for one aggregate over the rows."""
    failed = [
        F.count_if(~_holds(rule)).alias(f"{e.metric}.{name}")
        for e in expectations
        for name, rule in e.rules.items()
    ]
    return [F.count(F.lit(1)).alias(ROWS), *failed]


def meet(df: DataFrame, expectations: Sequence[Expectation], seen: Observation) -> DataFrame:
    """The rows that meet all rules that drop; `seen` gets the counts of all rules."""
    df = df.observe(seen, *all_counts(expectations))
    for expectation in expectations:
        for rule in expectation.rules.values() if expectation.drop else ():
            df = df.filter(F.expr(rule))
    return df


def counts_by_rule(
    counts: Mapping[str, int], expectations: Sequence[Expectation]
) -> list[tuple[str, str, int]]:
    """`metric`, `rule` and `n` of counted rules; the rows count under each metric."""
    out = []
    for e in expectations:
        out.append((e.metric, ROWS, counts.get(ROWS) or 0))
        out += [(e.metric, name, counts.get(f"{e.metric}.{name}") or 0) for name in e.rules]
    return out
