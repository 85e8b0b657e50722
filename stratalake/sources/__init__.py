"""Reading landed documents and source configuration; writing tables."""
