"""Whole jobs: each reads tables, applies the operators and writes tables or files."""
