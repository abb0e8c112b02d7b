"""Queries over the test tables and the SQL they are held against."""
