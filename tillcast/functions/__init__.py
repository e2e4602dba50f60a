"""Column helpers. All are built-in expressions; none is a UDF."""
