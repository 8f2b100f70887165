"""Whole exports: source to operator to sink, and the registered queries."""
