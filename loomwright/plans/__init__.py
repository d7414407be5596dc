"""The business' derived tables as declarative plans."""
