"""talespan plans."""
