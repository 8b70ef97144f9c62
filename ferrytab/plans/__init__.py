"""Whole migrations, and the queries over the test tables."""
