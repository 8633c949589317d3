"""Sales consolidation on PySpark: DataFrame-in, DataFrame-out operators and jobs."""
