"""Column functions: no I/O, no shuffles, built-in expressions only."""
