"""Column functions. Everything here takes and returns Columns and stays inside whole-stage codegen."""
