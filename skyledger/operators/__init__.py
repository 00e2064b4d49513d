"""Table-level steps, DataFrame in and DataFrame out, no storage access."""
