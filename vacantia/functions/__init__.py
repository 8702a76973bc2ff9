"""Column-to-column functions. None of them is a Python UDF."""
