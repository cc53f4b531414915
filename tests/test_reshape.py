"""Flat-cell reshaping: text holding many records' cells becomes typed rows."""

from __future__ import annotations

from conftest import INVOICE_ROWS, rows
from pyspark.sql import functions as F

from tierwise.operators import reshape
from tierwise.schemas import INVOICE


def test_whole_text_flat_cells_become_rows(spark, data_dir, invoices):
    text = spark.read.text(str(data_dir / "invoices.csv"), wholetext=True)
    names = [f.name for f in INVOICE.fields]
    cells = reshape.records_from_cells(text, "value", names, skip=len(names), record_sep="\r\n|\r")
    typed = cells.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in INVOICE.fields])
    assert rows(typed) == rows(invoices)


def test_chunks_keep_a_short_tail(spark):
    df = spark.createDataFrame([("h1,h2\ra,1\rb,2\rc",)], "t string")
    out = reshape.records_from_cells(df, "t", ["k", "v"], skip=2)
    assert [tuple(r) for r in out.collect()] == [("a", "1"), ("b", "2"), ("c", None)]


def test_read_flat_records_drops_headers(spark, data_dir, invoices):
    out = reshape.read_flat_records(spark, str(data_dir / "invoices.csv"), INVOICE, record_sep="\r")
    # The last record ends in CR LF, so its value text carries a trailing LF.
    assert out.count() == len(INVOICE_ROWS)


def test_reshape_record_to_key_value(spark, invoices):
    kv = reshape.reshape_record(invoices, ["legal_entity", "status"], ["rating", "value"])
    assert kv.columns == ["key", "value"]
    assert kv.count() == 18


def test_read_flat_records_cuts_long_records_into_rows(spark, tmp_path):
    from conftest import INVOICE_HEADER

    path = tmp_path / "flat.csv"
    # The second record holds two rows' cells end to end, the third one row.
    path.write_text("\r".join([INVOICE_HEADER, "1,L1,C1,1,ARAP,10,2,L2,C2,2,ARAP,20", "3,L3,C3,4,ACCR,30"]))
    out = reshape.read_flat_records(spark, str(path), INVOICE, record_sep="\r")
    assert sorted(tuple(r) for r in out.collect()) == [
        (1, "L1", "C1", 1, "ARAP", 10), (2, "L2", "C2", 2, "ARAP", 20), (3, "L3", "C3", 4, "ACCR", 30)
    ]


def test_records_from_cells_keeps_carried_columns(spark):
    df = spark.createDataFrame([("f1", "a,1\rb,2"), ("f2", "c,3")], "file string, t string")
    out = reshape.records_from_cells(df, "t", ["k", "v"], keep=["file"])
    assert sorted(tuple(r) for r in out.collect()) == [("f1", "a", "1"), ("f1", "b", "2"), ("f2", "c", "3")]


def test_wrong_widths_and_casts_are_rejected_and_quotes_kept(spark, tmp_path):
    path = tmp_path / "flat.csv"
    records = [
        "1,L1,C1,1,ARAP,10", "21,L2,C2,3,ACCR,40,1", '2,"L2, Inc",C2,2,ARAP,20', "3,L3,C3,x,ACCR,30",
        ",L4,C4,4,ARAP,", "4,L1,C1,1,ARAP,10,5,L2,C2,3e,ACCR,40", "6,L6",
    ]
    path.write_text("\r".join(records))
    good, bad = reshape.split_flat_records(spark, str(path), INVOICE)
    assert sorted(map(tuple, good.collect()), key=str) == sorted([
        (1, "L1", "C1", 1, "ARAP", 10), (2, "L2, Inc", "C2", 2, "ARAP", 20), (None, "L4", "C4", 4, "ARAP", None), (4, "L1", "C1", 1, "ARAP", 10),
    ], key=str)
    assert sorted(map(tuple, bad.collect())) == sorted([
        ("21,L2,C2,3,ACCR,40,1", "wrong number of cells"), ("6,L6", "wrong number of cells"),
        ("3,L3,C3,x,ACCR,30", "a cell does not cast"), ("5,L2,C2,3e,ACCR,40", "a cell does not cast"),
    ])


def test_a_text_is_split_once_however_many_rows_it_holds(spark):
    n = 20_000
    df = spark.range(1).select(
        F.lit("f").alias("file"),
        F.concat(F.lit("a,b,c\r"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(i, F.lit(",x,"), i * 2)), "\r"), F.lit(",tail\r")).alias("t"),
    )
    out = reshape.records_from_cells(df, "t", ["a", "b", "c"], skip=3, keep=["file"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1  # once a text, not once more per row
    got = out.collect()
    assert [tuple(r) for r in got[:2]] == [("f", "1", "x", "2"), ("f", "2", "x", "4")]
    assert tuple(got[-1]) == ("f", "tail", None, None) and len(got) == n + 1
    assert sum(int(r.c) for r in got[:-1]) == n * (n + 1)


def test_cells_end_as_the_expression_says(spark):
    ends = ["", "\r", "\r\r", "\r\n", "\r\r\n", "\n", "\r\u0085", "\r ", "\r\r ", ",", ",\r", "\r,", " \r", "x", "\rx", "\r\n\n"]
    df = spark.createDataFrame([(f"{start}{end}",) for start in ("", "a,b", "a\rb,é", "\r") for end in ends] + [(None,)], "t string")
    for sep, record_sep in ((",", "\r"), ("|", "\r"), (",", "b"), (",", "\r\n"), (",", "\r|\n")):
        want = F.split(F.regexp_replace(F.regexp_replace("t", f"(?:{record_sep})+$", ""), record_sep, sep), reshape._regex_literal(sep))
        both = df.select("t", reshape.cells(F.col("t"), sep, record_sep).alias("got"), want.alias("want")).collect()
        assert [r.t for r in both if r.got != r.want] == []
