"""tidegauge: time-series analytics on Spark DataFrames, all series in one long table keyed by ``ts_id``."""
