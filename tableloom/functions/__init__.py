"""Expressions, group sizing and shared storage used by the operators."""
