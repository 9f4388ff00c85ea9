"""Table readers and payload extractors."""
