"""Flight-operations lakehouse toolkit: every operator maps a DataFrame to a DataFrame."""
