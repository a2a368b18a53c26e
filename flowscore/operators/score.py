"""Scoring: one shared prepare step for batch and stream, label decoding,
confidence and the prediction document layout."""

from __future__ import annotations

from pyspark.ml.feature import IndexToString
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowscore.operators.conform import fill_zero
from flowscore.operators.features import vector_as_array
from flowscore.operators.train import FlowModel


def prepare(df: DataFrame, model: FlowModel, fill: str = "model") -> DataFrame:
    """Shared by batch and stream scoring so both see the same features.

    ``fill="model"``: missing numerics are left for the fitted imputer (mean);
    ``fill="zero"``: null / NaN numerics are zeroed first (the imputer then
    never acts)."""
    if fill == "zero":
        return fill_zero(df, model.features)
    if fill == "model":
        return df
    raise ValueError(f"fill must be 'model' or 'zero', not {fill!r}")


def decode_labels(df: DataFrame, labels: list[str], prediction: str = "prediction",
                  out: str = "prediction_label") -> DataFrame:
    """Class index -> label text; ``labels`` already includes the extra class."""
    return IndexToString(inputCol=prediction, outputCol=out, labels=labels).transform(df)


def with_confidence(df: DataFrame, probability: str = "probability",
                    out: str = "confidence") -> DataFrame:
    """Largest class probability; null when the model gives no probability."""
    if probability in df.columns:
        return df.withColumn(out, F.array_max(vector_as_array(probability)))
    return df.withColumn(out, F.lit(None).cast("double"))


def score(df: DataFrame, model: FlowModel, fill: str = "model") -> DataFrame:
    """Transform with the fitted pipeline, then decode label and confidence."""
    pred = model.pipeline.transform(prepare(df, model, fill))
    if model.labels is not None:
        pred = decode_labels(pred, model.labels)
    else:
        pred = pred.withColumn("prediction_label", F.col("prediction").cast("int").cast("string"))
    return with_confidence(pred)


DOCUMENT_COLUMNS = ["attack_type", "confidence", "prediction", "timestamp", "event_date",
                    "kafka_metadata"]


#: Columns of a scored row that hold vectors; published as arrays of numbers.
VECTOR_COLUMNS = ["features", "rawPrediction", "probability"]


def scored_row(scored: DataFrame) -> list:
    """The model's own columns of a scored row, fit for a document: category indexes, and vectors as arrays."""
    own = [F.col(c) for c in scored.columns if c.endswith("_index")]
    return own + [vector_as_array(c).alias(c) for c in VECTOR_COLUMNS if c in scored.columns]


def to_documents(scored: DataFrame, keep: list[str] = (), whole: bool = False) -> DataFrame:
    """Prediction document: ``attack_type`` = decoded label, ``confidence`` =
    max probability, ``kafka_metadata`` = struct(topic, partition, offset,
    timestamp); ``event_date`` = date of the timestamp (a partition column of
    the stored table, so time-bounded reads prune folders); ``keep`` lists
    extra record columns to publish.  ``whole`` publishes the scored row as well:
    indexes, features, raw predictions and probabilities (arrays)."""
    meta = F.struct(*[F.col(c) for c in ("topic", "partition", "offset", "timestamp")])
    return scored.select(
        *[F.col(c) for c in keep],
        F.col("prediction_label").alias("attack_type"),
        F.col("confidence"),
        F.col("prediction"),
        F.col("timestamp"),
        F.to_date(F.col("timestamp")).alias("event_date"),
        meta.alias("kafka_metadata"),
        *(scored_row(scored) if whole else []),
    )
