"""DataFrame-to-DataFrame operators, grouped by the part of the daily job they serve."""
