"""Spark-native annotation, dataset-audit and corpus operators: functions from DataFrame to DataFrame."""
