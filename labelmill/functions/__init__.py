"""Column expressions and exact rank selection shared by the operators."""
