from __future__ import annotations

import csv
import io


def golden(text: str) -> list[dict[str, str]]:
    return list(csv.DictReader(io.StringIO(text)))


def same(actual, expected: str) -> bool:
    """Cell of a Spark row against CSV text."""
    if actual is None:
        return expected == ""
    if isinstance(actual, bool):
        return str(actual) == expected
    if isinstance(actual, (int, float)):
        return expected != "" and float(actual) == float(expected)
    return actual == expected


def assert_rows(rows, text: str, key: tuple[str, ...]) -> None:
    expected = {tuple(r[k] for k in key): r for r in golden(text)}
    assert len(rows) == len(expected)
    for row in rows:
        match = expected[tuple(str(row[k]) for k in key)]
        for column, cell in match.items():
            assert same(row[column], cell), (column, row[column], cell)
