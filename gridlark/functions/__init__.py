"""Column expressions: no jobs, no Python workers."""
