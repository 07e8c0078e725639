"""Column builders: casts, scalars, masks and checks."""
