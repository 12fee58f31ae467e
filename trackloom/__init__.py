"""trackloom: DataFrame operators for multi-rate sensor recordings on Spark."""
