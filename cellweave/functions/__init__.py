"""Column expressions: semantics, names, agronomy, vectors, geometry, projection; SQL registration in registry."""
