"""Sources: Parquet tables, CSV (with header / headerless + names file),
file and Kafka streams, fitted models and stored predictions."""
