"""Machine-learning operators on ``pyspark.ml`` and exact metric tables."""
