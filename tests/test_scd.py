"""SCD2 / SCD1: edge loads, idempotence, a row-by-row Python model."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vaultline.operators import scd

SCHEMA = "customer_id string, name string, customer_type string"
AS_OF = ["2024-01-0%d 00:00:00" % i for i in range(1, 10)]


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _apply_all(spark, loads, insert_new_keys=True):
    silver = None
    for n, rows in enumerate(loads):
        silver = scd.scd2_apply(silver, _df(spark, rows), "customer_id", AS_OF[n], insert_new_keys=insert_new_keys)
        silver = silver.cache()
    return silver


def test_five_loads(spark):
    loads = [
        [("A", "a", "x"), ("B", "b", "x"), ("C", "c", "x")],
        [("A", "a", "y"), ("B", "b", "x"), ("C", "c", "x")],
        [("A", "a", "y"), ("B", "b", "x"), ("C", "c", "x")],
        [("A", "a", "z"), ("B", "b", "x"), ("C", "c", "x"), ("D", "d", "x")],
        [("A", "a", "z"), ("B", "b", "x"), ("D", "d", "x")],
    ]
    out = _apply_all(spark, loads).collect()
    assert len(out) == 6
    per = {}
    for r in out:
        per.setdefault(r.customer_id, []).append(r)
    assert len(per["A"]) == 3 and sum(r.is_current for r in per["A"]) == 1
    assert all(len(per[k]) == 1 and per[k][0].is_current for k in "BCD")
    a = sorted(per["A"], key=lambda r: r.effective_start)
    assert a[0].effective_end == a[1].effective_start and a[1].effective_end == a[2].effective_start


def test_null_changes(spark):
    first = [("1", "n", None), ("2", "n", "x"), ("3", "n", None)]
    second = [("1", "n", "x"), ("2", "n", None), ("3", "n", None)]
    out = _apply_all(spark, [first, second]).collect()
    versions = {}
    for r in out:
        versions[r.customer_id] = versions.get(r.customer_id, 0) + 1
    assert versions == {"1": 2, "2": 2, "3": 1}


def test_reapply_is_noop_and_existing_only(spark):
    first = [("1", "n", "x"), ("2", "n", "x")]
    second = [("1", "n", "y"), ("3", "n", "x")]
    once = _apply_all(spark, [first, second])
    twice = scd.scd2_apply(once, _df(spark, second), "customer_id", AS_OF[5])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    no_new = _apply_all(spark, [first, second], insert_new_keys=False)
    assert {r.customer_id for r in no_new.collect()} == {"1", "2"}


def model(loads):
    """Row-by-row SCD2 model: dict key -> list of [type, start, end, current]."""
    table = {}
    for n, rows in enumerate(loads):
        seen = {}
        for k, _, t in rows:
            seen[k] = max(seen.get(k, t) or "", t or "") if k in seen else t
        for k, t in seen.items():
            vs = table.get(k)
            if vs is None:
                table[k] = [[t, n, None, True]]
            else:
                cur = vs[-1]
                if cur[0] != t:
                    cur[2], cur[3] = n, False
                    vs.append([t, n, None, True])
    return table


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    loads=st.lists(
        st.lists(st.tuples(st.sampled_from("ABCD"), st.sampled_from(["x", "y"])), min_size=0, max_size=5,
                 unique_by=lambda r: r[0]),
        min_size=1,
        max_size=4,
    )
)
def test_matches_python_model(spark, loads):
    rows = [[(k, "n", t) for k, t in load] for load in loads]
    out = _apply_all(spark, rows).collect()
    expect = model(rows)
    got = {}
    for r in out:
        got.setdefault(r.customer_id, []).append(r)
    assert set(got) == set(expect)
    for k, vs in expect.items():
        assert len(got[k]) == len(vs)
        assert sum(r.is_current for r in got[k]) == 1
        assert sorted(r.customer_type for r in got[k]) == sorted(v[0] for v in vs)


def test_scd1_later_load_seq_wins(spark):
    target = spark.createDataFrame([("1", "c", "Active", 1)], "account_id string, customer_id string, status string, load_seq int")
    staging = spark.createDataFrame(
        [("1", "c", "Closed", 1), ("1", "c", "Dormant", 2), ("2", "d", "Active", 1)],
        "account_id string, customer_id string, status string, load_seq int",
    )
    out = {r.account_id: r.status for r in scd.scd1_upsert(target, staging, "account_id", ["load_seq"]).collect()}
    assert out == {"1": "Dormant", "2": "Active"}


def test_scd1_schema_rules(spark):
    import pytest

    target = spark.createDataFrame([("1", "a")], "account_id string, status string")
    extra = spark.createDataFrame([("1", "b", 5)], "account_id string, status string, branch int")
    with pytest.raises(ValueError):
        scd.scd1_upsert(target, extra, "account_id")
    merged = scd.scd1_upsert(target, extra, "account_id", merge_schema=True)
    assert merged.columns == ["account_id", "status", "branch"]
    lacking = spark.createDataFrame([("1",)], "account_id string")
    with pytest.raises(ValueError):
        scd.scd1_upsert(target, lacking, "account_id")


def test_dedupe_survivor_is_deterministic(spark):
    df = spark.createDataFrame([("1", "b", 1), ("1", "a", 1), ("1", "c", 0)], "k string, v string, seq int")
    assert scd.dedupe(df, ["k"], ["seq"]).first().v == "b"


def test_null_keys_skipped_and_reapply_stays_noop(spark):
    first = [("1", "n", "x"), (None, "n", "x")]
    once = _apply_all(spark, [first, first])
    assert sorted(r.customer_id for r in once.collect()) == ["1"]
    t = spark.createDataFrame([("1", "a")], "account_id string, status string")
    st = spark.createDataFrame([(None, "b"), ("2", "c")], "account_id string, status string")
    assert sorted(r.account_id for r in scd.scd1_upsert(t, st, "account_id").collect()) == ["1", "2"]


def test_several_tracked_columns(spark):
    schema = "customer_id string, country string, customer_type string"
    s1 = spark.createDataFrame([("1", "UK", "x"), ("2", "UK", "x")], schema)
    s2 = spark.createDataFrame([("1", "FR", "x"), ("2", "UK", "x")], schema)
    one = scd.scd2_apply(None, s1, "customer_id", AS_OF[0])
    only_type = scd.scd2_apply(one, s2, "customer_id", AS_OF[1])
    both = scd.scd2_apply(one, s2, "customer_id", AS_OF[1], tracked=("customer_type", "country"))
    assert only_type.count() == 2
    assert both.count() == 3
    cur = {r.customer_id: r.country for r in scd.current_only(both).collect()}
    assert cur == {"1": "FR", "2": "UK"}


def test_staging_missing_column_is_an_error(spark):
    import pytest

    one = scd.scd2_apply(None, _df(spark, [("1", "n", "x")]), "customer_id", AS_OF[0])
    lacking = spark.createDataFrame([("1", "x")], "customer_id string, customer_type string")
    with pytest.raises(ValueError):
        scd.scd2_apply(one, lacking, "customer_id", AS_OF[1])
