"""Column expressions: audit struct, calendar attributes, amounts, searches."""
