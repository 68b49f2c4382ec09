"""Column functions and the few dataset-level helpers every job shares."""
