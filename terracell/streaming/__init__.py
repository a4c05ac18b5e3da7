"""Incremental processing of newly arrived tiles."""
