"""Column expressions; every function takes and returns Columns and stays in generated code."""
