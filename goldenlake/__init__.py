"""Master data, SCD2 dimensions and a star schema as plain Spark DataFrame operators."""
