"""Column -> Column expressions.  All are built-in Spark expressions (codegen, no Python UDF)."""
