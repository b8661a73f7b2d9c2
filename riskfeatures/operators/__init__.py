"""Reusable relational operators, parameterised by column names."""
