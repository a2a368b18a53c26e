"""flowscore: Spark-native scoring of network-flow records.

Decode JSON records from a stream, conform them to a declared schema, fill
or impute missing values, profile columns, train and evaluate Spark ML
classifiers, score in batch and in Structured Streaming, write predictions
through an idempotent micro-batch sink and query the stored predictions.
"""

from flowscore.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
__version__ = "0.1.0"
