import contextlib
import io

from siftmark.spec import MarketSpec

SPEC = MarketSpec()


def rows(df, *order):
    """Rows as tuples, sorted by the given columns or by all."""
    data = [tuple(r) for r in df.collect()]
    index = [df.columns.index(c) for c in order] or range(len(df.columns))
    return sorted(data, key=lambda r: [(r[i] is not None, r[i]) for i in index])


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()
