"""brightwater: a Spark-native medallion engine for market and rate series."""
