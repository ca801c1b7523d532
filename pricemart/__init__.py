"""Market-data warehouse operators written as PySpark DataFrame functions."""
