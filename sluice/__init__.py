"""Spark-native data-quality, drift, feature, recommendation and model-operations jobs.

Every operator is a plain function from DataFrames to a DataFrame.
"""
