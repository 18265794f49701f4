"""Column functions: every one takes columns and returns a column, so all work stays in codegen."""
