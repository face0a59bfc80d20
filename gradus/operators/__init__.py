"""DataFrame operators; each module holds one family."""
