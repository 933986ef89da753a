"""Column functions: no shuffle, no Python in tasks."""
