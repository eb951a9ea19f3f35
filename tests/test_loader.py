"""Delimited load with quarantine (batch and streaming), clean view, sinks."""

import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from txrisk.sources.ingest import clean, ingest_transactions, read_ingested, read_transactions
from txrisk.sources.schema import TRANSACTION_SCHEMA
from txrisk.sources.sinks import write_result
from txrisk.streaming.ingest import start_ingest

LINES = [
    "1;Credit;100;FI",  # good
    "2;Debit;9.5;SE",  # not an int
    ";Debit;3;RO",  # good, NULL customer
    "4;Debit;;ROU",  # parses, country too long
    "5;Debit;7",  # field missing
    "6;Creditorsxyz;5;FI",  # sign too long
]
MORE_BAD = {"11;credit;5;FI": "unknown sign", "12;Credit;5;FI;x": "unparsable", "A13;Credit;5;FI": "unparsable",
            "14;Debit;99999999999;FI": "unparsable", "15;Debit;5;FIN": "country too long"}


def _write(lines, folder=None):
    d = Path(folder or tempfile.mkdtemp(prefix="txrisk-src-"))
    d.mkdir(parents=True, exist_ok=True)
    (d / f"part-{len(list(d.iterdir()))}.txt").write_text("\n".join(lines) + "\n")
    return str(d)


def test_read_transactions_quarantines_bad_lines(spark):
    good, bad = read_transactions(spark, _write(LINES))
    assert good.schema == TRANSACTION_SCHEMA
    rows = sorted(good.collect(), key=lambda r: (r[0] is None, r[0]))
    assert [tuple(r) for r in rows] == [(1, "Credit", 100, "FI"), (None, "Debit", 3, "RO")]
    reasons = {r["_corrupt_record"] or f"{r[0]}": r["load_status"] for r in bad.collect()}
    assert reasons["2;Debit;9.5;SE"] == "unparsable"
    assert reasons["5;Debit;7"] == "unparsable"
    assert reasons["4"] == "country too long"
    assert reasons["6"] == "sign too long"
    assert good.count() + bad.count() == len(LINES)


def test_every_bad_line_has_its_reason_whatever_is_read(spark):
    good, bad = read_transactions(spark, _write(["1;Credit;100;FI", "10;;5;", *MORE_BAD]))
    assert sorted(tuple(r) for r in good.collect()) == [(1, "Credit", 100, "FI"), (10, None, 5, None)]
    assert sorted(r[0] for r in bad.select("load_status").collect()) == sorted(MORE_BAD.values())
    assert good.count() == 2 and bad.count() == len(MORE_BAD)


def test_ingest_writes_both_outputs_in_one_pass(spark):
    out = tempfile.mkdtemp(prefix="txrisk-out-") + "/tx"
    ingest_transactions(spark, _write(LINES), out)
    assert read_ingested(spark, out).count() == 2
    statuses = {r[0] for r in spark.read.parquet(out).select("load_status").distinct().collect()}
    assert statuses == {"good", "unparsable", "country too long", "sign too long"}


def test_streaming_ingest_appends_each_file_once(spark):
    src = _write(LINES[:3])
    out = tempfile.mkdtemp(prefix="txrisk-stream-") + "/tx"
    ckpt = tempfile.mkdtemp(prefix="txrisk-sckpt-")
    start_ingest(spark, src, out, ckpt).awaitTermination(120)
    assert read_ingested(spark, out).count() == 2
    _write(LINES[3:] + ["7;Credit;70;DK"], src)
    start_ingest(spark, src, out, ckpt).awaitTermination(120)  # restart: only the new file
    assert read_ingested(spark, out).count() == 3
    assert spark.read.parquet(out).count() == len(LINES) + 1


def test_clean_keeps_positive_amounts_only(spark):
    df = spark.createDataFrame([(1, "Credit", 5, "FI"), (1, "Credit", 0, "FI"), (1, "Debit", -3, "FI"),
                                (1, "Debit", None, "FI")], TRANSACTION_SCHEMA)
    assert [r[2] for r in clean(df).collect()] == [5]


def test_write_result_csv_roundtrip(spark):
    df = spark.createDataFrame([(1, "Credit", 5, "FI")], TRANSACTION_SCHEMA)
    out = tempfile.mkdtemp(prefix="txrisk-csv-") + "/r"
    write_result(df, out, fmt="csv")
    back = spark.read.option("header", True).option("sep", ";").csv(out)
    assert back.select(F.col("TransactionCountry")).first()[0] == "FI"


def test_streaming_completeness_log(spark):
    from txrisk.streaming.ingest import start_completeness_log

    src = _write(LINES)
    out = tempfile.mkdtemp(prefix="txrisk-compl-") + "/log"
    ckpt = tempfile.mkdtemp(prefix="txrisk-cckpt-")
    start_completeness_log(spark, src, out, ckpt).awaitTermination(120)
    _write(["8;Debit;-20;SE"], src)
    start_completeness_log(spark, src, out, ckpt).awaitTermination(120)  # restart: only the new file
    log = spark.read.parquet(out)
    totals = log.agg(F.sum("total_records"), F.sum("quarantined_records"), F.sum("total_abs_amount")).first()
    assert tuple(totals) == (len(LINES) + 1, 4, 100 + 3 + 20)
    assert log.select("batch_id").distinct().count() == 2


def test_good_rows_do_not_depend_on_the_columns_read(spark, tmp_path):
    (tmp_path / "tx.txt").write_text("1;Credit;10;FI\n2;Debit;x;SE\n3;Debit\n5;Credit;9.5;DK\n7;Debit;4;FIN\n")
    good, bad = read_transactions(spark, str(tmp_path / "tx.txt"))
    assert [r.CustomerID for r in good.collect()] == [r.CustomerID for r in good.select("CustomerID").collect()] == [1]
    assert good.count() == 1 and bad.count() == 4


def test_two_drops_of_files_are_both_kept(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    for n, text in enumerate(("1;Credit;10;FI\n2;Debit;5;SE\n", "3;Debit;7;DK\n")):
        (src / f"{n}.txt").write_text(text)
        start_ingest(spark, str(src), out).awaitTermination()
    assert sorted(r.CustomerID for r in read_ingested(spark, out).collect()) == [1, 2, 3]
    with pytest.raises(ValueError):
        ingest_transactions(spark, str(src), out)
    ingest_transactions(spark, str(src), out + "2")
    with pytest.raises(ValueError):
        start_ingest(spark, str(src), out + "2")
