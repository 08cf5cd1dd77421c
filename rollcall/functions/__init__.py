"""Column functions: text clean-up, name normalisation and similarity."""
