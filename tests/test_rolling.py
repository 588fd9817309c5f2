"""Bucketed rolling count == plain window == brute force."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vaultline.operators.rolling import rolling_count, rolling_count_plain

SCHEMA = "tag string, k string, u long, v string"


def brute(rows, seconds):
    """rows: (tag, key, unix, value); count non-NULL values of the same key
    in [u - seconds, u]; NULL key or time -> NULL."""
    out = {}
    for tag, k, u, _ in rows:
        if k is None or u is None:
            out[tag] = None
        else:
            out[tag] = sum(
                1 for _, k2, u2, v2 in rows if k2 == k and u2 is not None and u - seconds <= u2 <= u and v2 is not None
            )
    return out


rows_strategy = st.lists(
    st.tuples(
        st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
        st.one_of(st.none(), st.integers(min_value=-2000, max_value=5000)),
        st.booleans(),
    ),
    min_size=1,
    max_size=40,
)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, seconds=st.sampled_from([0, 1, 300, 900]), bucket=st.sampled_from([None, 900, 1000]))
def test_bucketed_equals_brute_force(spark, rows, seconds, bucket):
    data = [(f"r{n}", k, u, f"v{n}" if has_value else None) for n, (k, u, has_value) in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA)
    got = {r.tag: r.c for r in rolling_count(df, "k", "u", seconds, "v", "c", bucket_seconds=bucket).collect()}
    plain = {r.tag: r.c for r in rolling_count_plain(df, "k", "u", seconds, "v", "c").collect()}
    expect = brute(data, seconds)
    assert got == expect
    assert plain == expect


def test_bucketed_on_fixture_equals_plain(spark):
    from vaultline.plans.catalog import prepared_raw

    base = prepared_raw(spark, "/root/testdata/sf0.001").withColumn("u", F.unix_timestamp("txn_timestamp"))
    for w, b in [(300, 300), (300, 3600), (21600, 21600), (21600, 86400)]:
        a = {r.transaction_id: r.c for r in rolling_count(base, "account_id", "u", w, "transaction_id", "c", b).collect()}
        p = {r.transaction_id: r.c for r in rolling_count_plain(base, "account_id", "u", w, "transaction_id", "c").collect()}
        assert a == p
