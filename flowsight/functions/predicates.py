"""Row predicates of a contract, each true or false and never NULL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowsight.contract import Contract

BLANKS = ("", "-")


def surely(condition: Column) -> Column:
    """The condition with NULL read as false."""
    return F.coalesce(condition, F.lit(False))


def folded(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def missing_text(name: str) -> Column:
    return ~surely(~F.trim(F.col(name)).isin(*BLANKS))


def unusable_number(name: str, *, floating: bool) -> Column:
    """NULL or negative; for floating columns NaN and the infinities as well."""
    value = F.col(name)
    usable = value >= 0
    if floating:
        usable = usable & (value < float("inf"))  # NaN sorts above infinity
    return ~surely(usable)


def label_known(name: str) -> Column:
    return surely(F.col(name).isin(0, 1))


def target_sound(contract: Contract) -> Column:
    """A positive id, a 0/1 label, and a class name that agrees with the label; may be NULL.

    For filters, where NULL drops the row: the parts on single columns reach the scan.
    """
    category = folded(contract.category)
    return (
        (F.col(contract.identifier) > 0)
        & F.col(contract.label).isin(0, 1)
        & ~category.isin(*BLANKS)
        & ((F.col(contract.label) == 0) == (category == contract.negative_name.lower()))
    )


def target_broken(contract: Contract) -> Column:
    """No positive id, no 0/1 label, no class name, or a class name that contradicts the label."""
    return ~surely(target_sound(contract))


def outcome(label: str = "label", prediction: str = "prediction") -> Column:
    """Confusion cell of a row; NULL when either side is not 0 or 1."""
    truth, guess = F.col(label), F.col(prediction)
    return (
        F.when((truth == 1) & (guess == 1), "true_positive")
        .when((truth == 0) & (guess == 1), "false_positive")
        .when((truth == 1) & (guess == 0), "false_negative")
        .when((truth == 0) & (guess == 0), "true_negative")
    )


def rows_where(condition: Column) -> Column:
    return F.count_if(surely(condition))


def long_rows(pairs: Iterable[tuple[Column | str, ...]], names: tuple[str, ...]) -> Column:
    """Turn columns of one row into rows: ``select(long_rows(...))``."""
    cells = [
        F.struct(*[(F.lit(v) if isinstance(v, str) else v).alias(n) for v, n in zip(pair, names)]) for pair in pairs
    ]
    return F.inline(F.array(*cells))
