"""Query catalogue: each key with its Spark plan and its SQL counterpart."""
