"""Column expressions: vectors, hashing, text and nutrition parsing."""
