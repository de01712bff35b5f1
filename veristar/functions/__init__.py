"""Column -> Column functions: text statistics, sentiment arithmetic, verdicts."""
