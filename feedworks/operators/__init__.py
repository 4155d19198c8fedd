"""DataFrame to DataFrame steps: refine, curate, report."""
