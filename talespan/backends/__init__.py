"""Pluggable language-model and embedding backends."""
