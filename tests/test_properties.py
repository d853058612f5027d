"""Property checks with generated inputs (few examples: each one runs Spark)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from playlens.operators.upsert import upsert

KEYS = st.one_of(st.none(), st.integers(min_value=0, max_value=8))
ROWS = st.lists(st.tuples(KEYS, st.text(alphabet="abc", max_size=2)), max_size=12)


def _model(target, source):
    counts = {}
    for k, _ in source:
        if k is not None:
            counts[k] = counts.get(k, 0) + 1
    valid = [(k, v) for k, v in source if k is not None and counts[k] == 1]
    keys = {k for k, _ in valid}
    return sorted([(k, v) for k, v in target if k not in keys] + valid, key=repr)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=ROWS, source=ROWS)
def test_upsert_matches_model(spark, target, source):
    t = spark.createDataFrame(target, "id long, v string")
    s = spark.createDataFrame(source, "id long, v string")
    out = upsert(t, s, ["id"])
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == _model(target, source)
    again = sorted((tuple(r) for r in upsert(out, s, ["id"]).collect()), key=repr)
    assert again == got                                        # idempotent
