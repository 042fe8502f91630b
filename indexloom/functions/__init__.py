"""Column functions: every one builds a Catalyst expression, none is a UDF."""
