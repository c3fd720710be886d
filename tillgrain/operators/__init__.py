"""Reusable distributed building blocks that Spark has no single built-in for."""
