"""Row-local operators on streaming DataFrames.

Encoding, standardizing (with statistics computed beforehand on a batch
table) and scoring are projections (or an Arrow UDF), so they apply
unchanged to a ``readStream`` source; no state is kept between micro-batches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.encode import encode_strings
from ..operators.mlp import MLPModel
from ..operators.scoring import predict
from ..operators.scale import standardize


def score_stream(
    stream: DataFrame,
    stats,
    model: MLPModel,
    features: Sequence[str] | str,
    output_col: str = "prediction",
    mapping: Mapping[str, float] | None = None,
    strings: Sequence[str] | None = None,
    method: str = "auto",
) -> DataFrame:
    """Encode -> standardize -> predict on a streaming (or batch) DataFrame."""
    out = stream
    if mapping is not None:
        out = encode_strings(out, strings, mapping)
    out = standardize(out, stats, list(features) if not isinstance(features, str) else None)
    return predict(out, model, features, output_col, method)


def write_available_now(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Process everything available now, append it to ``path`` and stop."""
    return (df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())
