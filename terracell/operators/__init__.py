"""Operators over feature tables and cell tables."""
