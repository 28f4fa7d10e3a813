"""Property tests: operators against small pure-Python models."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohortkit.functions.numbers import parse_number
from cohortkit.operators.relational import first_per_key

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)),   # key (NULL allowed)
                          st.integers(0, 3),                          # order column (ties)
                          st.integers(0, 1000)),                      # unique tail via index
                min_size=1, max_size=40)


@SETTINGS
@given(rows)
def test_first_per_key_is_min_by_order(spark, data):
    data = [(k, o, i) for i, (k, o, _) in enumerate(data)]
    df = spark.createDataFrame(data, "k long, o long, i long")
    got = {r.k: (r.o, r.i) for r in first_per_key(df, "k", ["o", "i"]).collect()}
    exp = {}
    for k, o, i in data:
        if k not in exp or (o, i) < exp[k]:
            exp[k] = (o, i)
    assert got == exp


_PLAIN = re.compile(r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$")


def _model(text, style):
    if text is None:
        return None
    s = text.strip()
    if style == "comma":
        s = s.replace(",", ".")
    elif style == "br":
        s = re.sub(r"\s+", "", text).replace(".", "").replace(",", ".")
    return float(s) if _PLAIN.match(s) else None


numbers = st.one_of(
    st.none(),
    st.from_regex(r"\A[ ]?[+-]?[0-9]{1,4}([.,][0-9]{1,3})?([.,][0-9]{1,2})?[ ]?\Z"),
    st.sampled_from(["abc", "", "nan", "1.0d", "1e3", "1 234,5", ".5", "5.", "-", "1.2.3"]))


@SETTINGS
@given(st.lists(numbers, min_size=1, max_size=30))
def test_parse_number_matches_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = df.select(*[parse_number("x", s).alias(s) for s in ("plain", "comma", "br")]).collect()
    for t, r in zip(texts, got):
        for s in ("plain", "comma", "br"):
            assert r[s] == _model(t, s), (t, s, r[s])
