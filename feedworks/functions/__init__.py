"""Column builders and named transforms."""
