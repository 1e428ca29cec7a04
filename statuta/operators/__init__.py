"""Operators on whole tables of articles."""
