"""Order-insensitive comparison of a Spark result with a DuckDB oracle, columns by name."""

import math
from collections import Counter


def value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(value(x) for x in v)
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(n for n in names), Counter(tuple(value(r[i]) for i in order) for r in data)


def compare(df, con, sql):
    got_names, got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_names, want = rows([d[0] for d in cur.description], cur.fetchall())
    assert got_names == want_names
    if got != want:
        raise AssertionError(f"{sum(got.values())} and {sum(want.values())} rows; only in Spark: {list((got - want).items())[:4]}; only in the oracle: {list((want - got).items())[:4]}")
    return sum(got.values())
