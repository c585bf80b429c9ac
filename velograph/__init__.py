"""velograph: a PySpark-native engine for road-speed profiles, and operators for training-data pipelines."""
