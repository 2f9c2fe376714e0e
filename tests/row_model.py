"""The grid rules once more, row by row in plain Python, as a second opinion."""

from __future__ import annotations

import re

KEYS = [
    (r"medicare\s+advantage", "ma"),
    ("medicare", "me"),
    ("year", "yr"),
    ("total", "tot"),
    ("enrollment", "enroll"),
    ("original", "orig"),
    ("percentage", "pct"),
    ("without", "wo"),
    ("count", "ct"),
    ("/", "_"),
    (r"\s+", "_"),
]


def short_key(header):
    key = header.lower()
    for pattern, short in KEYS:
        key = re.sub(pattern, short, key)
    return key


def cells_of(row):
    return [c.strip() for c in row if c is not None and c.strip()]


def facts_of(rows):
    """(heading, row index, key, short key, value, first key, first value) of a sheet, or None on overflow."""
    compacted = [cells_of(r) for r in rows]
    start = next((i for i, c in enumerate(compacted) if len(c) > 1), None)
    if start is None:
        return []
    head, heading, index, out = compacted[start], "", 0, []
    for cells in compacted[start + 1 :]:
        if not cells or cells[0] == "BLANK":
            continue
        if len(cells) == 1 and re.search("[A-Za-z]", cells[0]):
            heading = cells[0]
            continue
        if len(cells) > len(head):
            return None
        record = {name: value for name, value in zip(head[1:], cells[1:])}
        out += [(heading, index, k, short_key(k), v, head[0], cells[0]) for k, v in record.items()]
        index += 1
    return out
