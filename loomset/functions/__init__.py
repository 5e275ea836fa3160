"""Column functions: every function takes and returns a Column."""
