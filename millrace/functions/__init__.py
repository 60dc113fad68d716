"""Column expressions: text, markup, nested values, windows of text and hashed vectors."""
