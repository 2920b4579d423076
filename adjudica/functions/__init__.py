"""Column expressions and the feature functions built from them."""
