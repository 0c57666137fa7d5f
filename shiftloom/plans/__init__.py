"""Composite jobs, one lazy plan each."""
