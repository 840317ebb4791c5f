"""Property tests: the audit operators against a brute-force Python model."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stellate.functions import dense_key
from stellate.operators import (
    distinct_count,
    distinct_per_group,
    duplicate_keys,
    duplicate_rows,
    full_row_duplicates,
)

ROWS = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.sampled_from(["a", "b", "c", None])),
    min_size=0,
    max_size=40,
)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


@SETTINGS
@given(rows=ROWS)
def test_duplicate_audits_match_brute_force(spark, rows):
    df = _frame(spark, rows)
    counts = Counter(k for k, _ in rows)
    assert {(r["k"], r["count"]) for r in duplicate_keys(df, "k").collect()} == {
        (k, c) for k, c in counts.items() if c > 1}
    # rows of repeated keys; NULL keys never match the equality join
    want = Counter(r for r in rows if r[0] is not None and counts[r[0]] > 1)
    for how in ("semi", "join"):
        assert Counter(tuple(r) for r in duplicate_rows(df, "k", how=how).collect()) == want
    whole = Counter(rows)
    assert {tuple(r) for r in full_row_duplicates(df).collect()} == {
        (k, v, c) for (k, v), c in whole.items() if c > 1}
    assert distinct_count(df, "k").first()[0] == len({k for k, _ in rows})
    per = {}
    for k, v in rows:
        if v is not None:
            per.setdefault(k, set()).add(v)
    assert {(r["k"], r["c"]) for r in distinct_per_group(df, "k", "v").collect()} == {
        (k, len(vs)) for k, vs in per.items() if len(vs) > 1}


@SETTINGS
@given(rows=ROWS)
def test_dense_key_is_the_rank_in_total_order(spark, rows):
    df = _frame(spark, rows).repartition(3)
    got = [(r["k"], r["v"], r["sk"]) for r in dense_key(df, ["k"], "sk").collect()]
    assert sorted(sk for _, _, sk in got) == list(range(1, len(rows) + 1))

    def order(t):  # NULLs first, as Spark's ascending order
        return tuple((x is not None, x if x is not None else 0) for x in t)

    ranked = sorted(got, key=lambda t: t[2])
    assert [order(t[:2]) for t in ranked] == sorted(order(t[:2]) for t in got)
