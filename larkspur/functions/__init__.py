"""Column builders: expressions in, expressions out."""
