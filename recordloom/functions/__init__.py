"""Column expressions: normalisers, tokens, address components, string similarity."""
