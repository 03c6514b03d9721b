from collections import Counter


def rows(df, *columns):
    """Rows as sorted tuples (NULLs first)."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def same_rows(a, b):
    """Equal as multisets of rows, column order aside."""
    assert sorted(a.columns) == sorted(b.columns)
    order = sorted(a.columns)

    def bag(df):
        return Counter(repr(tuple(r)) for r in df.select(*order).collect())

    return bag(a) == bag(b)


def plan(df):
    """Text of the physical plan; the final one if the frame already ran."""
    return df._jdf.queryExecution().executedPlan().toString()


def write_text(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)
