"""Column expressions and plan shapes shared by the operators."""
