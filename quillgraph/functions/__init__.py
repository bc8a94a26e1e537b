"""Column functions: lines, fields and package rows, all built from built-in functions."""
