"""Column-level operators on the wide event frame."""
