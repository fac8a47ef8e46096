"""Column expressions and the few Python helpers (fuzzy ratio)."""
