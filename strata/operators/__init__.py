"""Relational and key operators."""
