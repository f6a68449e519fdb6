"""DataFrame-to-DataFrame operators; lazy, keyed by partition-key columns."""
