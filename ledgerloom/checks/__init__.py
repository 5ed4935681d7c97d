"""Independent SQL statements of the same results, for side-by-side checks."""
