"""Column expressions (no DataFrames, no actions)."""
