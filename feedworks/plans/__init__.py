"""Stage drivers over all feeds, and session sizing."""
