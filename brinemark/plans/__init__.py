"""Composite jobs: what a user runs."""
