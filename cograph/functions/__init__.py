"""Column-level functions: scaling (F1-F3, F9) and ranking helpers."""
