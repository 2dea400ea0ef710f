"""Relational operators over numeric data, one module per operator family."""
