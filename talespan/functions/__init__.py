"""talespan functions."""
