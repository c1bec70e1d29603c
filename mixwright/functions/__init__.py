"""Marketing measurement on Spark."""
