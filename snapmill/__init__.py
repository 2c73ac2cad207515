"""snapmill: monthly table snapshots to model-ready features and labels, on Spark."""
