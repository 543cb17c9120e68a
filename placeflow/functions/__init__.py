"""Column expressions (builtin Catalyst functions plus two Arrow functions)."""
