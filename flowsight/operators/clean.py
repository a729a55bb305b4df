"""Cleaning of a labelled table, and removal of keys with contradictory labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsight.contract import Contract
from flowsight.functions.predicates import folded, missing_text, target_sound, unusable_number
from flowsight.operators.quality import key_groups
from flowsight.session import written

UNKNOWN = "__unknown__"


def canonical_category(contract: Contract) -> Column:
    """One spelling per class name; unlisted names keep theirs, label 0 is the negative name."""
    pairs = [F.lit(text) for item in contract.category_names.items() for text in item]
    own = F.trim(F.col(contract.category))
    listed = F.element_at(F.create_map(*pairs), folded(contract.category)) if pairs else own
    return F.when(F.col(contract.label) == 0, contract.negative_name).otherwise(F.coalesce(listed, own))


def clean_rows(
    df: DataFrame, contract: Contract, *, missing_token: str = UNKNOWN, carry: Sequence[str] = (), unique: bool = False
) -> DataFrame:
    """Drop rows with a broken target and exact copies, then normalise every column.

    Copies are rows equal in the contract's columns, identifier included, as they came in.
    ``carry`` names further columns to keep, taken from one of the copies. ``unique`` says that
    the identifiers are known to be unique, so that there are no copies and nothing is shuffled.
    """

    def tidy(name: str) -> Column:
        if name in contract.categorical:
            value = F.when(missing_text(name), missing_token).otherwise(folded(name))
        elif name == contract.category:
            value = canonical_category(contract)
        elif name in contract.numeric:
            bad = unusable_number(name, floating=contract.is_floating(name))
            value = F.when(bad, F.lit(0).cast(contract.schema[name].dataType)).otherwise(F.col(name))
        else:
            value = F.col(name)
        return value.alias(name)

    sound = df.select(*contract.columns, *carry).where(target_sound(contract))
    if not unique and carry:
        kept = F.min(F.struct(*carry)).alias("_carry")
        sound = sound.groupBy(*contract.columns).agg(kept).select(*contract.columns, "_carry.*")
    elif not unique:
        sound = sound.distinct()
    return sound.select(*[tidy(name) for name in contract.columns], *carry)


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row of each key: of several, the least by the other columns in their order, NULL first.

    The keys alone are counted, in a hash table. Rows whose key occurs once go through as they are;
    only rows of repeated keys are brought together and compared. NULL is a key like any other.
    """
    repeated = written(df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_key"), "repeated-keys")
    same = df[key].eqNullSafe(repeated["_key"])
    rest = [name for name in df.columns if name != key]
    least = F.min(F.struct(*rest)).alias("_least")
    several = df.join(repeated, same, "left_semi").groupBy(key).agg(least).select(key, "_least.*").select(*df.columns)
    return df.join(repeated, same, "left_anti").unionByName(several)


def conflicting_keys(df: DataFrame, key: str, label: str = "label") -> DataFrame:
    """Keys with more than one label; missing labels are not compared."""
    return key_groups(df, key, label).where(F.col("low_label") != F.col("high_label")).select(key)


def without_conflicts(df: DataFrame, key: str, label: str = "label") -> DataFrame:
    """Drop every row of a key with contradictory labels."""
    return df.join(written(conflicting_keys(df, key, label), "conflicting-keys"), key, "left_anti").select(*df.columns)


def only_conflicts(df: DataFrame, key: str, label: str = "label") -> DataFrame:
    """The rows that ``without_conflicts`` drops."""
    return df.join(written(conflicting_keys(df, key, label), "conflicting-keys"), key, "left_semi").select(*df.columns)


def single_label_rows(df: DataFrame, key: str, label: str = "label") -> DataFrame:
    """Rows of the keys that have exactly one label.

    The keys to leave out are few and the keys to keep many, so this is an anti join with the
    former rather than a semi join with the latter.
    """
    one_label = F.coalesce(F.col("low_label") == F.col("high_label"), F.lit(False))
    others = written(key_groups(df, key, label).where(~one_label).select(key), "ambiguous-keys")
    return df.where(F.col(key).isNotNull()).join(others, key, "left_anti").select(*df.columns)
