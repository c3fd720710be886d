"""Operators for large text corpora; each module states the cases its operator defines."""
