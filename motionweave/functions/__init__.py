"""Column expressions: everything here builds Catalyst expressions, no actions."""
