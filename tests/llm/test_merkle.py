import random
import zlib
from hashlib import sha256

from pyspark.sql import functions as F

from tests.llm.cases import edge_docs, edge_rows, no_docs
from vaultline.llm.merkle import fold, manifest, proof_text

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r):
    return h(*(enc(v) for v in (r[0], r[3], r[2], r[4], r[1])))


def tree(digests, fanout=8):
    """(root, proofs): a proof lists (left, right) from the leaf up."""
    proofs, nodes, at = [[] for _ in digests], list(digests), list(range(len(digests)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for k, a in enumerate(at):
            run = runs[a // fanout]
            proofs[k].append(("".join(run[: a % fanout]), "".join(run[a % fanout + 1 :])))
        nodes, at = [h(*r) for r in runs], [a // fanout for a in at]
    return nodes[0], proofs


def brute(rows, fanout=8):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    found = {}
    for g in names:
        part = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        found[g] = (part, *tree([leaf(r) for r in part], fanout))
    root, tops = tree([found[g][1] for g in names], fanout)
    out = []
    for g, top in zip(names, tops, strict=True):
        part, sub, proofs = found[g]
        out += [(r[0], leaf(r), sub, root, h(*(a + b for a, b in p + top))) for r, p in zip(part, proofs, strict=True)]
    return sorted(out, key=str)


def rows_of(df):
    got = df.select("id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256))
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_groups_of_many_sizes(spark):
    rng = random.Random(2)
    rows = [(d, rng.choice(["é", "Text", "", None]), g, rng.choice(["s", None]), rng.choice([3, None])) for g, n in (("en", 600), ("de", 9), (None, 8), ("é", 1), ("fr", 65)) for d in rng.sample(range(10_000), n)]
    rows += [(d, "x", f"l{d}", "s", 1) for d in range(20)]  # more groups than a parent holds
    df = spark.createDataFrame(rows, SCHEMA).repartition(9)
    assert rows_of(manifest(df)) == brute(rows)
    assert rows_of(manifest(df, fanout=3)) == brute(rows, 3)


def test_one_group_and_one_row(spark):
    rows = [(d, "t", "en", "s", 1) for d in range(70)]
    assert rows_of(manifest(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert rows_of(manifest(spark.createDataFrame(rows[:1], SCHEMA))) == brute(rows[:1])


def test_altered_leaves_do_not_fold_to_the_root(spark):
    rows = [(d, "Some Text" if d % 2 else "plain", "en" if d % 3 else None, "s", 1) for d in range(200)]
    got = manifest(spark.createDataFrame(rows, SCHEMA), altered={"text": F.lower("text")})
    got = got.select("id", (fold(F.col("altered_leaf"), F.col("path")) == F.col("root")).alias("same"), (fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("own"))
    for r in got.collect():
        assert r["same"] == (r["id"] % 2 == 0) and r["own"]


def test_edges(spark):
    rows = [r[:5] for r in edge_rows()]
    got = manifest(edge_docs(spark))
    assert rows_of(got) == brute(rows) and got.columns == ["id", "grp", "idx", "leaf", "altered_leaf", "subroot", "root", "path"]
    assert manifest(no_docs(spark)).count() == 0
    twins = [(1, "same", "en", "s", 4)] * 40
    assert rows_of(manifest(spark.createDataFrame(twins, SCHEMA))) == brute(twins)


def test_no_window_over_a_group(spark):
    """Only counts for each partition pass through a window; texts are not shuffled."""
    df = spark.createDataFrame([(d, "t" * 500, "en", "s", 1) for d in range(3000)], SCHEMA)
    plan = manifest(df)._jdf.queryExecution().toString()
    assert "row_number" not in plan and "text#" not in plan.split("== Physical Plan ==")[1]


def test_crc32_is_unsigned(spark):
    got = {r[0]: r[1] for r in spark.range(300).select("id", F.crc32(F.col("id").cast("string").cast("binary"))).collect()}
    assert got == {d: zlib.crc32(str(d).encode()) for d in range(300)}
