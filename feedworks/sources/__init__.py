"""Feed specs, the raw text scan, and tables."""
