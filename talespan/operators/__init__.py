"""Distributed operators of the core."""
