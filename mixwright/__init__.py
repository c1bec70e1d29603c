"""Marketing measurement operators and training-data pipeline stages on Spark."""
