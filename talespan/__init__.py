"""talespan: a PySpark engine for timed transcripts, segments and thesaurus links."""

__version__ = "0.1.0"
