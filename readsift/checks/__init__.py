"""Registered queries, the views they run on, and their SQL twins."""
