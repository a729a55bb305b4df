"""Hash expressions: fingerprints, split buckets and order-free table signatures."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def fingerprint(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields as JSON; NULL fields stay in the JSON."""
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


def hash_bucket(key: str, *, seed: int, buckets: int) -> Column:
    """Bucket of a key, independent of partitioning. The type of the key column matters."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(int(seed))), F.lit(int(buckets)))


def portable_bucket(key: str, *, seed: int, buckets: int) -> Column:
    """Same idea from MD5, which other engines can compute too."""
    text = F.concat(F.col(key).cast("string"), F.lit(f":{int(seed)}"))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(int(buckets)))


def portable_key(key: str) -> Column:
    """60 bits of the MD5 of a key, spread over the range of a long, as the order of a sample."""
    return F.shiftleft(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 15), 16, 10).cast("bigint") - (1 << 59), 4)


MARKS = 60


def bit_marks(conditions: Sequence[Column]) -> list[Column]:
    """The conditions as bits of as few longs as hold them; NULL is no."""
    bits = [F.when(condition, F.lit(1 << (place % MARKS))).otherwise(F.lit(0)).cast("bigint") for place, condition in enumerate(conditions)]
    groups = [bits[low : low + MARKS] for low in range(0, len(bits), MARKS)]
    return [reduce(lambda left, right: left.bitwiseOR(right), group) for group in groups]


def has_mark(marks: Sequence[str], place: int) -> Column:
    """Whether the condition at a place was met, of the columns that ``bit_marks`` made."""
    return F.col(marks[place // MARKS]).bitwiseAND(F.lit(1 << (place % MARKS))) != 0


def row_digest(columns: Sequence[str]) -> list[Column]:
    """Two longs that stand for the values of a row, in place of the whole row in a shuffle.

    Both hash all columns, in opposite orders and after different starts, so different rows share
    both by chance only: 10^11 rows with a probability of about 10^-17. Spark's hash passes over
    NULL, so where NULL is goes into the hash as well.
    """
    nulls = bit_marks([F.col(name).isNull() for name in columns])
    named = [F.col(name) for name in columns]
    return [F.xxhash64(F.lit(1), *nulls, *named), F.xxhash64(F.lit(2), *reversed(named), *nulls)]


def row_hash(columns: Sequence[str]) -> Column:
    """A long for the values of a row; where NULL is goes into it, which Spark's hash passes over."""
    return F.xxhash64(*bit_marks([F.col(name).isNull() for name in columns]), *[F.col(name) for name in columns])


def signature_sum(columns: Sequence[str]) -> Column:
    return F.sum(row_hash(columns).cast("decimal(20,0)"))


def signature_figures(columns: Sequence[str]) -> dict[str, Column]:
    """``rows, signature`` as aggregates: equal for equal tables, whatever their order and partitions."""
    total = F.coalesce(signature_sum(columns), F.lit(0)).cast("string") if columns else F.lit("0")
    return {"rows": F.count(F.lit(1)), "signature": total}
