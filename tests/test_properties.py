"""Property tests against plain-Python references."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stormlake.functions.dates import parse_dates_per_file

PY_FORMATS = ["%m/%d/%Y", "%Y-%m-%d", "%d/%m/%Y"]   # the source's order
RENDER = [lambda d: f"{d.month}/{d.day}/{d.year}", lambda d: f"{d.year}-{d.month}-{d.day}",
          lambda d: f"{d.day}/{d.month}/{d.year}"]


def _expected(texts):
    vals = [t for t in texts if t is not None and t != "nan"]
    for i, f in enumerate(PY_FORMATS):
        try:
            parsed = [dt.datetime.strptime(t, f).date() for t in vals]
        except ValueError:
            continue
        it = iter(parsed)
        return i, [None if (t is None or t == "nan") else next(it) for t in texts]
    return None, [None] * len(texts)


files = st.lists(
    st.tuples(st.integers(0, 2),
              st.lists(st.one_of(st.dates(dt.date(1973, 1, 1), dt.date(2024, 12, 31)), st.just(None)),
                       min_size=1, max_size=12)),
    min_size=1, max_size=4)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(files)
def test_format_choice_matches_python(spark, spec):
    rows, exp = [], {}
    for f, (fmt, dates) in enumerate(spec):
        texts = [None if d is None else RENDER[fmt](d) for d in dates]
        if any(t is None for t in texts):
            texts = ["nan" if t is None else t for t in texts]
        exp[f] = _expected(texts)
        rows += [(f, i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "f int, i int, d string")
    got = {}
    for r in parse_dates_per_file(df, "d", ["f"]).collect():
        got.setdefault(r.f, {})[r.i] = (r.date_format, r.d)
    for f, (fmt, values) in exp.items():
        g = got[f]
        assert all(g[i][0] == fmt for i in g), (f, fmt, g)
        assert [g[i][1] for i in range(len(values))] == values
