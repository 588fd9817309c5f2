import pytest

from tests.llm.cases import edge_docs, edge_rows, no_docs
from vaultline.llm.mixing import SCHEDULES, mix_sources, position, source_targets, training_order, training_places
from vaultline.llm.queries import op6_mix_curriculum
from vaultline.llm.stages import mixing
from pyspark.sql import functions as F


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    done, left = {}, sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in done]
        rate = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if rate * weight[s] > most * sizes[s] + 1e-9]
        if not over:
            return done | {s: rate * weight[s] for s in open_}
        for s in over:
            done[s] = most * sizes[s]
            left -= most * sizes[s]


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 10, "c": 1, None: 50}, {"x": 5}, {"a": 0, "b": 7, "é": 90, "z": 3, "zz": 3}, {"a": 1, "b": 1, "c": 1000, "d": 1, "e": 2, "f": 900}])
def test_targets_match_brute_force(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_positions_invert_the_integrated_schedule(spark):
    for k, knots in enumerate(SCHEDULES):
        shares = [i / 20 for i in range(21)]
        df = spark.createDataFrame([(s, k) for s in shares], "s double, k long")
        got = [r[0] for r in df.select(position(F.col("s"), F.col("k"))).collect()]

        def area(t, knots=knots):
            total = 0.0
            for (a, u), (b, v) in zip(knots, knots[1:], strict=False):
                x = min(max(t - a, 0), b - a)
                total += u * x + (v - u) / (b - a) * x * x / 2
            return total

        assert [area(t) / area(1.0) for t in got] == pytest.approx(shares, abs=1e-9)


def test_taken_words_meet_targets(spark):
    rows = [(k, " ".join(["w"] * (1 + k * 7 % 40)), "hot" if k % 3 == 0 else f"s{k % 5}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_sources(docs).collect()
    again = mix_sources(docs.repartition(7)).collect()
    key = lambda r: (r["doc_id"], r["taken"], tuple(r["positions"]))
    assert sorted(map(key, got)) == sorted(map(key, again))
    taken, target = {}, {}
    for r in got:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"] and r["taken"] == r["size"] * r["copies"] == r["size"] * len(r["positions"])
        assert all(0 <= p <= 1 for p in r["positions"]) and list(r["positions"]) == sorted(r["positions"])
    assert all(abs(taken[s] - target[s]) <= 20 for s in target)


def test_training_order_is_sorted_by_position(spark):
    docs = spark.createDataFrame([(k, "a b c " * (k % 9 + 1), f"s{k % 4}") for k in range(200)], "doc_id long, text string, source string")
    mixed = mix_sources(docs)
    rows = training_order(docs).collect()
    places = {}
    for r in mixed.collect():
        places[r["doc_id"]] = list(r["positions"])
    order = [places[r["doc_id"]].pop(0) for r in rows]
    assert order == sorted(order) and not any(places.values())


def test_query_numbers_the_copies_in_training_order(spark, tmp_path):
    rows = [(k if k % 11 else None, "a b c " * (k % 9 + 1), f"s{k % 4}" if k % 4 else None) for k in range(300)] + [(400, None, "s1")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = op6_mix_curriculum(spark, str(tmp_path)).collect()
    assert len(got) == 301 and all(len(r["places"]) == r["copies"] for r in got)
    copies = sorted((n, p, r["doc_id"]) for r in got for n, p in zip(r["places"], r["positions"], strict=True))
    assert [n for n, *_ in copies] == list(range(len(copies))) and [p for _, p, _ in copies] == sorted(p for _, p, _ in copies)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [d for *_, d in copies] == [r["doc_id"] for r in training_order(docs).collect()]
    assert training_places(mix_sources(no_docs(spark))).count() == 0


def test_equal_rows_share_the_positions_of_their_key(spark):
    rows = [(k // 4, "a b c", "s", k % 4) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    taken = sum(r["copies"] for r in mix_sources(docs).collect())
    got = training_order(docs)
    assert got.columns == docs.columns and got.count() == taken == 40
    assert sorted(tuple(r) for r in got.collect()) == sorted(rows)


def test_edge_rows(spark):
    got = mix_sources(edge_docs(spark)).collect()
    assert len(got) == len(edge_rows()) and all(r["taken"] == 0 for r in got if r["size"] == 0)
    stage = mixing(spark, edge_docs(spark), "")
    assert stage.columns == edge_docs(spark).columns and stage.count() > 0
    assert mix_sources(no_docs(spark)).count() == 0 and mixing(spark, no_docs(spark), "").count() == 0
