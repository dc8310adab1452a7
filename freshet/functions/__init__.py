"""Column expressions: everything here stays inside code generation."""
