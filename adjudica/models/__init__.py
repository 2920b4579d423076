"""Models fitted and applied on the cluster."""
