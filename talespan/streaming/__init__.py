"""talespan streaming."""
