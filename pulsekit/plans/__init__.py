"""Stand-in inputs over the shared tables and the query registry."""
