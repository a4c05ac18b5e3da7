"""Operators for building training corpora. Nothing else in terracell imports this subpackage."""
