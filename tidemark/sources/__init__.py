"""Reading: discovery, files, tables, streams."""
