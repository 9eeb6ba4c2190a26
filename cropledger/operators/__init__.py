"""DataFrame-to-DataFrame operators; columns are parameters."""
