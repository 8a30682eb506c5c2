"""Registered queries over the star-schema tables, and their independent SQL."""
