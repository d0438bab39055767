"""Plain-Python comparison of result rows."""

import math


def same(a, b, tolerance=1e-9):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        return math.isclose(a, b, rel_tol=tolerance, abs_tol=tolerance)
    return a == b


def assert_rows(df, expected, order):
    """``df`` sorted by ``order`` has exactly the rows of ``expected`` (dicts)."""
    got = [row.asDict() for row in df.orderBy(*order).collect()]
    assert len(got) == len(expected), f"{len(got)} rows, expected {len(expected)}"
    for found, want in zip(got, expected):
        for name, value in want.items():
            assert same(found[name], value), f"{name}: {found[name]} != {value} in {found}"


def assert_equal_tables(a, b, order):
    assert sorted(a.columns) == sorted(b.columns)
    assert_rows(a.select(*b.columns), [row.asDict() for row in b.orderBy(*order).collect()], order)
