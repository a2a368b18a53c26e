"""DataFrame operators: conform, profile, features, train, evaluate, score,
serve, monitor and retention.  Each one is a composition of built-in
DataFrame / Spark ML operations."""
