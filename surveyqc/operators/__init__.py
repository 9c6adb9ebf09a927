"""DataFrame → DataFrame steps."""
