"""Column-expression builders (pure ``pyspark.sql.functions``; no UDFs)."""
