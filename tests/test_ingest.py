"""Ingest keeps every column and row, binds by name, and shows what it could not read."""

import json
import os

import pytest
from pyspark.sql.types import StructType

from vaultline.plans import jobs
from vaultline.session import scratch_path
from vaultline.sources import files, tables
from vaultline.sources.files import CORRUPT, read_csv, read_json
from vaultline.schemas import CREDIT_HISTORY, CUSTOMERS, TRANSACTIONS

AS_OF = "2026-01-01 00:00:00"


def put(spark, **files):
    path = scratch_path(spark, "raw").replace("file:", "")
    os.makedirs(path)
    for name, text in files.items():
        with open(os.path.join(path, name), "w") as f:
            f.write(text)
    return path


def test_csv_binds_by_header_and_keeps_columns(spark):
    raw = put(spark, a="customer_id,customer_type,name,email,country,risk_category\n1,RETAIL,Ann,a@x,India,High\n")
    row = read_csv(spark, raw, CUSTOMERS).first().asDict()
    assert row == {"customer_id": "1", "name": "Ann", "country": "India", "customer_type": "RETAIL", "risk_category": "High", "email": "a@x", CORRUPT: None}


def test_csv_bad_fields_and_lines_are_shown(spark):
    raw = put(spark, a="customer_id,credit_score,open_loans,last_default_date\n1,7x0,2,2020-01-01\n2,700,1,notadate\n3,650\n4,600,,\n5,1,2,2020-01-01,extra\n")
    rows = {r["customer_id"]: r for r in read_csv(spark, raw, CREDIT_HISTORY).collect()}
    assert rows["1"][CORRUPT] == "credit_score=7x0" and rows["1"]["credit_score"] is None
    assert rows["2"][CORRUPT] == "last_default_date=notadate"
    assert rows["3"][CORRUPT] == "3,650" and rows["5"][CORRUPT] == "5,1,2,2020-01-01,extra"
    assert rows["4"][CORRUPT] is None and rows["4"]["open_loans"] is None


def test_csv_missing_declared_column_is_null(spark):
    raw = put(spark, a="customer_id,name\n1,Ann\n")
    assert read_csv(spark, raw, CUSTOMERS).first()["country"] is None


def test_csv_files_with_other_headers_fail(spark):
    raw = put(spark, a="customer_id,name\n1,Ann\n", b="name,customer_id\nBob,2\n")
    with pytest.raises(Exception):
        read_csv(spark, raw, CUSTOMERS).collect()


DOC = '[\n {"transaction_id": "t1",\n  "amount": 5.0, "note": "x"},\n {"transaction_id": "t2",\n  "amount": 1.0}\n]\n'


@pytest.mark.parametrize("text", [DOC, '{"transaction_id": "t1", "amount": 5.0, "note": "x"}\n{"transaction_id": "t2", "amount": 1.0}\n', '\n[{"transaction_id": "t1", "amount": 5.0, "note": "x"}, {"transaction_id": "t2", "amount": 1.0}]\n'])
def test_json_form_is_recognised(spark, text):
    rows = read_json(spark, put(spark, a=text), TRANSACTIONS).orderBy("transaction_id").collect()
    assert [(r["transaction_id"], r["amount"], r["note"], r[CORRUPT]) for r in rows] == [("t1", 5.0, "x", None), ("t2", 1.0, None, None)]


ROW = '{"transaction_id": "%s", "amount": 5.0}\n'


@pytest.mark.parametrize("bad", ['{"transaction_id": "t0", "amo\n', "\ufeff" + ROW % "t0", "{'transaction_id': 't0'}\n"])
def test_json_lines_survive_a_bad_first_line(spark, bad):
    rows = read_json(spark, put(spark, a=bad + ROW % "t1" + ROW % "t2", b=ROW % "t3"), TRANSACTIONS).collect()
    assert len(rows) == 4 and {"t1", "t2", "t3"} <= {r["transaction_id"] for r in rows}
    assert all(r[CORRUPT] is None for r in rows if r["transaction_id"] in ("t1", "t2", "t3"))


def test_json_lines_and_documents_in_one_folder(spark):
    array = '[\n{"transaction_id": "t5", "amount": 5.0},\n{"transaction_id": "t6", "amount": 5.0}\n]\n'
    raw = put(spark, **{"a [1] b%20": ROW % "t3" + "cut\n" + ROW % "t4", "b": DOC, "c x": array})
    rows = read_json(spark, raw, TRANSACTIONS).collect()
    assert sorted(r["transaction_id"] for r in rows if r[CORRUPT] is None) == ["t1", "t2", "t3", "t4", "t5", "t6"]
    assert [r[CORRUPT] for r in rows if r[CORRUPT] is not None] == ["cut"] and "x" in {r["note"] for r in rows}


def test_folder_of_lines_is_not_listed(spark):
    raw = put(spark, **{f"f{k}": ROW % f"t{k}" + "cut\n" + ROW % f"u{k}" for k in range(5)})
    assert files._json_forms(spark, raw) == ([], [])
    assert sorted(r["transaction_id"] for r in read_json(spark, raw, TRANSACTIONS).collect() if r[CORRUPT] is None) == [f"{a}{k}" for a in "tu" for k in range(5)]


@pytest.mark.parametrize("text", [DOC, '{"transaction_id": "t1", "amount": 5.0, "note": "x"}\n{"transaction_id": "t2", "amount": 1.0}\n'])
def test_declared_columns_alone(spark, text):
    got = read_json(spark, put(spark, a=text), TRANSACTIONS, undeclared=False)
    assert got.columns == [*TRANSACTIONS.fieldNames(), CORRUPT]
    assert sorted((r["transaction_id"], r["amount"], r[CORRUPT]) for r in got.collect()) == [("t1", 5.0, None), ("t2", 1.0, None)]
    lake = jobs.Lake(scratch_path(spark, "lake"))
    jobs.ingest(spark, lake, "transactions", put(spark, a=text), AS_OF, undeclared=False)
    assert "note" not in jobs.read_bronze(spark, lake, "transactions").columns and jobs.rejected_count(spark, lake, "transactions") == 0


def test_rejected_rows_stay_in_bronze_and_go_no_further(spark):
    lake = jobs.Lake(scratch_path(spark, "lake"))
    raw = put(spark, a='{"transaction_id": "t1", "amount": 5.0}\n{"transaction_id": "t2", "amount": "many"}\nnot json\n')
    jobs.ingest(spark, lake, "transactions", raw, AS_OF)
    assert tables.read_table(spark, lake.bronze("transactions")).count() == 3
    assert jobs.rejected_count(spark, lake, "transactions") == 2
    assert [r["transaction_id"] for r in jobs.read_bronze(spark, lake, "transactions").collect()] == ["t1"]


RECORDS = [{"transaction_id": f"t{k}", "amount": k + 0.5, "metadata": {"ip": "1.2.3.4", "tags": [{"a": [k, "}, {"]}]}, "note": "x]},{"} for k in range(3000)]


@pytest.mark.parametrize("style", ["indent 2", "tabs", "joined", "crlf"])
def test_indented_documents_are_cut_between_records(spark, style):
    import json

    text = json.dumps(RECORDS, indent="\t" if style == "tabs" else 2)
    if style == "joined":  # both braces on one line, records at the left edge
        rows = [json.dumps(r, indent=2) for r in RECORDS]
        text = "[ " + ", ".join(rows) + " ]"
    raw = put(spark, **{"a.json": text.replace("\n", "\r\n") if style == "crlf" else text, "b.json": json.dumps(RECORDS[:2], indent=2), "c.json": json.dumps(RECORDS[7]) + "\n"})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64KB")
    try:
        got = read_json(spark, raw, TRANSACTIONS)
        assert got.rdd.getNumPartitions() > 3  # a.json alone is several splits
        rows = got.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 3003 and all(r[CORRUPT] is None for r in rows)
    assert sorted((r["transaction_id"], r["amount"]) for r in rows) == sorted((r["transaction_id"], r["amount"]) for r in [*RECORDS, *RECORDS[:2], RECORDS[7]])
    assert {r["note"] for r in rows} == {"x]},{"}


def test_a_bad_record_of_a_cut_document_costs_itself(spark):
    import json

    text = json.dumps(RECORDS[:50], indent=2).replace('"amount": 7.5', '"amount": 7.5.5')
    rows = read_json(spark, put(spark, a=text), TRANSACTIONS, split_over=0).collect()
    assert len(rows) == 50 and sum(r[CORRUPT] is not None for r in rows) == 1
    whole = read_json(spark, put(spark, a=json.dumps(RECORDS[:50])), TRANSACTIONS, split_over=0)  # on one line: nothing to cut at
    assert whole.count() == 50


def test_rows_name_their_file_and_rejected_ones_have_a_table(spark):
    import json

    raw = put(spark, a=json.dumps(RECORDS[:9], indent=2).replace('"amount": 3.5', '"amount": "x"'), b=json.dumps({"transaction_id": "l", "amount": 1.0}) + "\n{bad\n")
    lake = jobs.Lake(scratch_path(spark, "lake"))
    for over in (0, 1 << 30):  # cut or whole
        jobs.ingest(spark, lake, "transactions", raw, AS_OF, split_over=over, provenance=True)
        bronze = tables.read_table(spark, lake.bronze("transactions"))
        assert {r["_source_file"].rsplit("/", 1)[1] for r in bronze.collect()} == {"a", "b"}
        bad = sorted((r["source_file"].rsplit("/", 1)[1], "bad" in r["reason"]) for r in tables.read_table(spark, lake.bronze("transactions_rejected")).collect())
        good = jobs.read_bronze(spark, lake, "transactions")
        if over:  # read whole, a bad record costs its document
            assert set(bad) == {("a", False), ("b", True)}
        else:
            assert bad == [("a", False), ("b", True)] and good.count() == 9
        assert not {"_source_file", "_source_block"} & set(good.columns)


def test_documents_are_read_once_from_the_file(spark, tmp_path):
    """Numbers that a declared text column takes keep their text, and the
    parser does not open the file again for each of them."""
    rows = ",\n  ".join(f'{{"id": {k}.50, "ref": {k}e2, "n": {k}, "more": [{k}, "é"]}}' for k in range(1500))
    (tmp_path / "good.json").write_text(f"[\n  {rows}\n]\n", encoding="utf-8")
    (tmp_path / "bom.json").write_text('\ufeff{\n "id": "a",\n "ref": -0\n}', encoding="utf-8")
    (tmp_path / "bad.json").write_text('[\n {"id": 7.0, "n": "x"},\n {"id": 8', encoding="utf-8")
    (tmp_path / "wrong.json").write_text('[\n {"id": 7.0, "n": "x"},\n {"id": 8.10}\n]', encoding="utf-8")
    schema = StructType.fromDDL("id string, ref string, n int")
    read = lambda: sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    docs = read_json(spark, str(tmp_path), schema, provenance=True)
    before = read()
    got = docs.collect()
    assert read() - before < 3 * sum(f.stat().st_size for f in tmp_path.iterdir())
    assert ("3.50", "3e2", 3) in [(r["id"], r["ref"], r["n"]) for r in got] and ("a", "-0", None) in [(r["id"], r["ref"], r["n"]) for r in got]
    key = lambda r: json.dumps(r.asDict(recursive=True), sort_keys=True)
    assert sorted(map(key, got)) == sorted(map(key, read_json(spark, str(tmp_path), schema, multiline=True, provenance=True).collect()))
