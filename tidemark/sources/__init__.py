"""Reading landed files, keeping raw, snapshot and history tables, and finding tables."""
