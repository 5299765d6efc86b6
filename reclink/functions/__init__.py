"""Column functions: plain expressions in, plain expressions out."""
