"""Column-to-column functions; none of them runs a job."""
