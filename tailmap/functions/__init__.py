"""Column functions over reads, alignments and coordinates."""
