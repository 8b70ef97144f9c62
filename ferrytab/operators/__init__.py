"""Operators over whole tables: mapping, rules, reconciliation, lineage, questions and progress."""
