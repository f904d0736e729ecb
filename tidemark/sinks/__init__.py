"""Writing: files, tables, views, layout and schema enforcement."""
