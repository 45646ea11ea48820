"""Encoding of string and boolean columns.

The reference looks strings up in a Python dict through a row-at-a-time UDF;
here the lookup is a Catalyst map literal, so it stays inside whole-stage
codegen and folds with the other projections.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import columns_of_type, drop_columns

# The default string-to-number map of the reference.
DEFAULT_STRING_MAP = {
    "Yes": 1.0, "No": 0.0,
    "yes": 1.0, "no": 0.0,
    "true": 1.0, "false": 0.0,
}


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def string_code(c: Column, mapping: Mapping[str, float], unknown: str = "null", name: str = "") -> Column:
    """Map a string column through ``mapping`` to double.

    ``unknown="null"``: a value outside the map (or null) gives null.
    ``unknown="raise"``: a non-null value outside the map fails the job.
    """
    if not mapping:
        raise ValueError("mapping is empty")
    pairs: list[Column] = []
    for key, value in mapping.items():
        pairs += [F.lit(str(key)), F.lit(float(value))]
    looked_up = F.try_element_at(F.create_map(*pairs), c)
    if unknown == "null":
        return looked_up
    if unknown == "raise":
        return F.when(c.isNotNull() & looked_up.isNull(),
                      F.raise_error(F.concat(F.lit(f"unknown category in {name}: "), c))
                      ).otherwise(looked_up).cast("double")
    raise ValueError("unknown must be 'null' or 'raise'")


def encode_strings(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    mapping: Mapping[str, float] = DEFAULT_STRING_MAP,
    unknown: str = "null",
) -> DataFrame:
    """Encode string columns to double by ``mapping``.

    ``columns=None`` takes every string column, as the reference does; drop
    free-text columns first.  Non-string columns in ``columns`` are skipped.
    """
    strings = set(columns_of_type(df, "string"))
    targets = [c for c in (columns if columns is not None else sorted(strings)) if c in strings]
    if not targets:
        return df
    return df.withColumns({c: string_code(_q(c), mapping, unknown, c) for c in targets})


def encode_booleans(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Cast boolean columns to double 0/1 (E3, E4); ``None`` takes all."""
    booleans = set(columns_of_type(df, "boolean"))
    targets = [c for c in (columns if columns is not None else sorted(booleans)) if c in booleans]
    if not targets:
        return df
    return df.withColumns({c: _q(c).cast("double") for c in targets})


def unknown_counts(df: DataFrame, columns: Sequence[str], mapping: Mapping[str, float]) -> DataFrame:
    """Per column: rows whose non-null value is outside ``mapping`` (one pass)."""
    keys = [str(k) for k in mapping]
    aggs = [F.count_if(_q(c).isNotNull() & ~_q(c).isin(keys)).alias(c) for c in columns]
    wide = df.agg(*aggs)
    return wide.unpivot([], list(columns), "column_name", "unknown")


def prepare(
    df: DataFrame,
    drop: Iterable[str] = (),
    mapping: Mapping[str, float] = DEFAULT_STRING_MAP,
    strings: Sequence[str] | None = None,
    booleans: Sequence[str] | None = None,
    unknown: str = "null",
) -> DataFrame:
    """Drop, then encode strings, then booleans (E5): one projection after Catalyst."""
    out = drop_columns(df, drop)
    out = encode_strings(out, strings, mapping, unknown)
    return encode_booleans(out, booleans)
