"""Row-wise work on streams: the same column rules and models as in batch.

Statistics are never estimated on the stream. Fills come from a batch fit over
reference rows and are literals in the streaming plan, so the stream keeps no state.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..models.library import score
from ..operators.clean import CleanPlan, drop_missing, keep_columns, mode_row
from ..operators.quantiles import medians_row


def fitted_fills(plan: CleanPlan, reference: DataFrame) -> dict[str, object]:
    """The plan's fills as plain values (one per column) measured on cleaned reference rows."""
    typed = plan.apply_rules(reference)
    medians = [c for c, rule in plan.fills.items() if rule == "median"]
    values: dict[str, object] = dict(plan.fills)
    if medians:
        values.update(medians_row(typed, medians).first().asDict())
    for c, rule in plan.fills.items():
        if rule == "mode":
            values[c] = mode_row(typed, c).first()[c]
    return {c: v for c, v in values.items() if v is not None}


def clean_stream(stream: DataFrame, plan: CleanPlan, fills: Mapping[str, object]) -> DataFrame:
    rows = plan.apply_rules(stream)
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})
    rows = drop_missing(rows, plan.identity) if plan.identity else rows
    return keep_columns(rows, plan.order) if plan.order else rows


def score_stream(stream: DataFrame, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    return score(model, stream, features)


def write_stream(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append to a Parquet folder, taking what is available and then stopping."""
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", folder)
        .trigger(availableNow=True).start()
    )
