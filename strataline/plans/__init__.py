"""Query compilation and slice planning for remote sources."""
