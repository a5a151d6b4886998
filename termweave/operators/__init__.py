"""DataFrame-level building blocks shared by the plans."""
