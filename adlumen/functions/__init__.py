"""Column expressions. Everything here is a built-in Spark expression, no UDFs."""
