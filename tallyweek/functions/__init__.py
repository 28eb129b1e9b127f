"""Column-level building blocks: conditional aggregates and derived scalars."""
