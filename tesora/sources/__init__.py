"""Getting rows in and out: extracts, landing, control tables, sinks."""
