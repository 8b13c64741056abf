"""Column expressions. Nothing here runs Python code per row."""
