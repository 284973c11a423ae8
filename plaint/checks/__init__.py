"""Queries over the shared test tables, and the SQL that must give the same rows."""
