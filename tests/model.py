"""A sequential, one-row-at-a-time model of change capture to check the operators against."""

from __future__ import annotations


def position(row):
    """Sequence, then operation, then content with nulls first."""
    content = tuple((v is not None, v) for v in (row["a"], row["b"]))
    return (row["seq"], {"u": 0, "d": 1, "t": 2}[row["op"]], content)


def scd1(rows, ignore_nulls=False):
    """Rows are dicts with k, seq, op (u, d, t), a, b; returns {key: (a, b)}."""
    state: dict = {}
    for row in sorted((r for r in rows if r["seq"] is not None), key=position):
        if row["op"] == "t":
            state.clear()
        elif row["op"] == "d":
            state.pop(row["k"], None)
        else:
            old = state.get(row["k"], (None, None))
            new = (row["a"], row["b"])
            if ignore_nulls:
                new = tuple(o if n is None else n for n, o in zip(new, old))
            state[row["k"]] = new
    return state


def scd2(rows, ignore_nulls=False, tracked=None):
    """Returns a set of (key, a, b, valid_from, valid_to)."""
    by_key: dict = {}
    for row in sorted((r for r in rows if r["seq"] is not None), key=position):
        tied = by_key.setdefault(row["k"], {})
        before = tied.get(row["seq"])
        if ignore_nulls and before and before["op"] == row["op"] == "u":
            merged = {c: before[c] if row[c] is None else row[c] for c in ("a", "b")}
            row = {**row, **merged}
        tied[row["seq"]] = row
    result = set()
    for key, changes in by_key.items():
        open_version, filled = None, (None, None)
        for seq in sorted(changes):
            row = changes[seq]
            if row["op"] == "d":
                if open_version:
                    result.add((key, *open_version[1], open_version[0], seq))
                open_version, filled = None, (None, None)
                continue
            values = (row["a"], row["b"])
            if ignore_nulls:
                values = tuple(f if v is None else v for v, f in zip(values, filled))
                filled = values
            same = False
            if open_version and tracked is not None:
                same = all(open_version[1][i] == values[i] for i in tracked)
            if same:
                open_version = (open_version[0], values)
                continue
            if open_version:
                result.add((key, *open_version[1], open_version[0], seq))
            open_version = (seq, values)
        if open_version:
            result.add((key, *open_version[1], open_version[0], None))
    return result
