"""Model operators on ``pyspark.ml`` and DataFrame aggregates.

Only model coefficients, scaler statistics (two numbers per feature),
category levels and metric rows ever reach the driver; data stays in Spark.
"""
