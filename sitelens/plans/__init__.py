"""Analysis queries over the marts and the source tables, and publishing."""
