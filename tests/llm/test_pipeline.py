import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_packing import check_layout
from vaultline.llm import queries
from vaultline.llm.packing import CAPACITY, tokenizer_json

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at, counts = docs, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, SF)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        at = spark.createDataFrame(out.collect(), out.schema)
        counts.append(at.count())
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] == counts[2]
    tk = Tokenizer.from_str(tokenizer_json())
    want = []
    for r in at.collect():
        ids = np.array([*tk.encode(r["text"] or "", add_special_tokens=False).ids, 0], np.uint32)
        want += [(r["doc_id"], p, s, min(CAPACITY, len(ids) - s), zlib.crc32(ids[s : s + CAPACITY].tobytes())) for p, s in enumerate(range(0, len(ids), CAPACITY))]
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    check_layout(got, CAPACITY)


def test_every_operator_is_registered():
    numbers = {int(name[2:].split("_")[0]) for name in queries.QUERIES}
    assert numbers == set(range(1, 14))
