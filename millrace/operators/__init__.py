"""DataFrame to DataFrame operators. Each works on batches, and on streams where it keeps no state."""
