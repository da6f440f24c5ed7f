"""Operators of the create path and the read path."""
