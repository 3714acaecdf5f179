"""Input sources: text lines, in-memory rows, delimited records, archives, nested records."""
