"""Column builders: every function returns a Column or a dict of Columns."""
