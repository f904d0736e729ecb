from __future__ import annotations

import pytest

#: Null and empty texts, a very long one, repeated rows and texts, columns with names the operators use.
LONG = "the long text goes on and on without end " * 3000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, keep_id string, score string, node int"


@pytest.fixture(scope="session")
def edge_docs(spark):
    texts = [
        (1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "one two three"), (6, LONG), (7, LONG), (8, LONG + "end"),
        (9, "a fine sentence of nine words stands right here"), (9, "a fine sentence of nine words stands right here"),
        (10, "ünïcödé ß 漢字 😀 text"), (11, "\x00 odd ​ signs"), (12, None), (None, "no id at all here"), (13, "x" * 5000),
    ]
    return spark.createDataFrame(
        [(i, t, "en" if (i or 0) % 2 else None, None if (i or 0) % 3 == 0 else f"s{(i or 0) % 3}", None, i, "k", None, 1) for i, t in texts], SCHEMA
    )


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
