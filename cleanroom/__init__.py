"""Record cleaning, auditing, entity resolution and normalization on PySpark."""
