"""cairnflow: a PySpark-native engine for registry-style data pipelines."""
