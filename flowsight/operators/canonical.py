"""From raw text tokens to the contract, keeping a record of what could not be read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsight.contract import FLOW, RAW_FLOW, Contract, RawLayout, require_columns
from flowsight.functions.hashing import fingerprint
from flowsight.functions.tokens import blank, parse_token, plain_text


def parsed_tokens(raw: DataFrame, layout: RawLayout) -> DataFrame:
    """Each raw column read once, as ``p_<name>``, beside the text it came from."""
    require_columns(raw, layout.columns)
    texts = [plain_text(c).alias(f"p_{c}") for c in layout.columns if c in layout.texts]
    numbers = [parse_token(c, layout.kind(c)).alias(f"p_{c}") for c in layout.numeric]
    return raw.select("*", *texts, *numbers)


def token_problems(layout: RawLayout) -> list:
    """Two array columns: number fields that are not numbers, and number fields that are blank."""
    # array_except with NULL drops the empty places and, unlike array_compact, stays in generated code
    nothing = F.array(F.lit(None).cast("string"))
    malformed = [F.when(~blank(c) & F.col(f"p_{c}").isNull(), F.lit(c)) for c in layout.numeric]
    missing = [F.when(blank(c), F.lit(c)) for c in layout.numeric]
    return [
        F.array_except(F.array(*malformed), nothing).alias("malformed_fields"),
        F.array_except(F.array(*missing), nothing).alias("missing_fields"),
    ]


def flow_key(layout: RawLayout):
    """Fingerprint of everything but the targets, so copies match whatever their label."""
    return fingerprint([F.col(f"p_{c}").alias(c) for c in layout.columns if c not in (layout.category, layout.label)])


def canonical_rows(
    raw: DataFrame, *, contract: Contract = FLOW, layout: RawLayout = RAW_FLOW, source_file: str | None = None
) -> DataFrame:
    """The contract's columns, the fingerprint, the source file and the two problem arrays.

    The identifier is unique but depends on the partitioning: write the result before using it.
    """
    if source_file is None:
        require_columns(raw, ["source_file"])
    elapsed = F.col(f"p_{layout.duration}")
    packets = sum((F.col(f"p_{c}").cast("double") for c in layout.packets[1:]), F.col(f"p_{layout.packets[0]}").cast("double"))
    derived = {
        contract.identifier: F.monotonically_increasing_id() + 1,
        "rate": F.when(elapsed > 0, F.try_divide(packets, elapsed)).otherwise(0.0),
        contract.category: F.when(F.col(f"p_{layout.label}") == 0, contract.negative_name).otherwise(
            F.trim(F.col(layout.category))
        ),
        **{c: F.col(layout.renames[c]) for c in contract.categorical},
    }
    types = {f.name: f.dataType for f in contract.schema.fields}
    types[contract.identifier] = "bigint"

    def place(name: str):
        value = derived[name] if name in derived else F.col(f"p_{layout.renames[name]}")
        return value.cast(types[name]).alias(name)

    origin = F.lit(source_file) if source_file is not None else F.col("source_file")
    return parsed_tokens(raw, layout).select(
        *[place(name) for name in contract.columns],
        flow_key(layout).alias("flow_fingerprint"),
        origin.cast("string").alias("source_file"),
        *token_problems(layout),
    )
