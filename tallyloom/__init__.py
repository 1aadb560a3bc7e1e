"""tallyloom: a PySpark-native analytics engine for on-chain and social activity data."""
