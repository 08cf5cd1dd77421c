"""DataFrame operators: clean, de-duplicate, resolve, review and rank names."""
