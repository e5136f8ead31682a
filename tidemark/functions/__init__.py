"""Column helpers: small expressions, no jobs."""
