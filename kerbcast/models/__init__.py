"""Model fitting and scoring on pyspark.ml."""
