"""Relational operators of the signal engine, on article frames."""
