"""DataFrame operators; each takes column names, so it runs on any schema."""
