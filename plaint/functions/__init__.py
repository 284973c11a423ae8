"""Column functions: built-in expressions, and Arrow kernels where arrays are wide."""
