"""Job compositions (Q1-Q6) and the registry of checkable queries."""
