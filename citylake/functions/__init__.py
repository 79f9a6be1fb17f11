"""Column expressions: no DataFrame, no I/O, no Python UDF."""
