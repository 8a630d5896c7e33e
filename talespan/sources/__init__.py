"""talespan sources."""
