"""Column functions: every one maps columns to a column and stays inside Spark's own expressions."""
