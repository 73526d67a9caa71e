"""Ordered category rules, exclusion lists and the category domain.

A rule list becomes one ``CASE WHEN`` expression (first match wins, else the
column keeps its value), so it runs inside whole-stage codegen with no UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.text import upper_like_any


@dataclass(frozen=True)
class Rule:
    """``label`` applies when every given condition holds.

    sign: 'debit' (amount < 0), 'credit' (amount > 0) or None.
    txn_type: exact transaction_type value required, or None.
    patterns: upper-case LIKE patterns matched against upper(description); any may match.
    """

    label: str
    sign: str | None = None
    txn_type: str | None = None
    patterns: tuple[str, ...] = field(default_factory=tuple)

    def condition(self, amount: Column, txn_type: Column, text: Column) -> Column:
        cond = F.lit(True)
        if self.sign == "debit":
            cond = cond & (amount < 0)
        elif self.sign == "credit":
            cond = cond & (amount > 0)
        if self.txn_type is not None:
            cond = cond & (txn_type == F.lit(self.txn_type))
        if self.patterns:
            cond = cond & upper_like_any(text, self.patterns)
        return cond


# The deterministic override rules of the bank model, in order.
DEFAULT_RULES: tuple[Rule, ...] = (
    Rule("Endowus", sign="debit", patterns=("%UOB KAY HIAN%",)),
    Rule("Transfer", sign="credit", txn_type="Credit Card", patterns=("%PAYMT%",)),
    Rule("Income", sign="credit", patterns=("%SALA%", "%SALARY%", "%PAYROLL%")),
    Rule("Income", sign="credit", patterns=("%GOV |%", "%GST VOUCHER%", "%CDC VOUCHER%", "%SKILLSFUTURE%", "%WORKFARE%")),
    Rule("Income", sign="credit", patterns=("%CASH REBATE%", "%CASHBACK%", "%REBATE%")),
    Rule("Reimbursement", sign="credit", txn_type="", patterns=("PAYNOW OTHR |%",)),
)

# Categories removed from spend, and the classifier's label set.
EXCLUDED_CATEGORIES: tuple[str, ...] = ("Transfer", "Income", "Reimbursement", "Endowus")
CATEGORY_DOMAIN: tuple[str, ...] = (
    "Groceries", "Dining", "Transport", "Entertainment", "Shopping", "Utilities", "Healthcare",
    "Travel", "Education", "Insurance", "Investment", "Endowus", "Transfer", "Other",
)


def rules_expr(
    rules: Sequence[Rule],
    otherwise: Column,
    amount: str = "amount",
    txn_type: str = "transaction_type",
    text: str = "description",
) -> Column:
    expr = None
    a, t, d = F.col(amount), F.col(txn_type), F.col(text)
    for r in rules:
        cond = r.condition(a, t, d)
        expr = F.when(cond, F.lit(r.label)) if expr is None else expr.when(cond, F.lit(r.label))
    return otherwise if expr is None else expr.otherwise(otherwise)


def apply_rules(
    df: DataFrame,
    rules: Sequence[Rule] = DEFAULT_RULES,
    target: str = "category",
    amount: str = "amount",
    txn_type: str = "transaction_type",
    text: str = "description",
) -> DataFrame:
    """Replace ``target`` by the first matching rule's label (else keep it)."""
    return df.withColumn(target, rules_expr(rules, F.col(target), amount, txn_type, text))


def exclude(df: DataFrame, column: str, values: Iterable[str] = EXCLUDED_CATEGORIES) -> DataFrame:
    """``column NOT IN values``.  NULL is dropped too (SQL three-valued logic)."""
    return df.filter(~F.col(column).isin(list(values)))


def category_domain(df: DataFrame, column: str = "category", domain: Iterable[str] = CATEGORY_DOMAIN) -> DataFrame:
    """Rows whose ``column`` is outside the allowed domain (violations report).

    The domain is a fixed short list, so ``isin`` keeps it a filter in codegen
    rather than a join.
    """
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(domain)))
