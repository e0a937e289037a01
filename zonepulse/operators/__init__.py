"""DataFrame operators; column names are always parameters."""
