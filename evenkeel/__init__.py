"""evenkeel: prepare, balance, scale and evaluate labelled records on Spark."""
