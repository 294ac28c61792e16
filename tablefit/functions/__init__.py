"""Column expressions: fixed values, typed cells, label expressions, vectors."""
