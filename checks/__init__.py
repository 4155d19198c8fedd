"""Queries over the library, their expected results in SQL, and the feeds they read."""
