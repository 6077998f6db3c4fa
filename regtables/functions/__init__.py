"""Column functions: they take Columns and return Columns, no jobs, no Python workers."""
