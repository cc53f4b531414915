"""Incremental totals from a stream of arriving fact files."""

from __future__ import annotations

from conftest import INVOICE_HEADER, INVOICE_ROWS, rows

from tierwise.functions.metrics import invoice_metrics
from tierwise.operators import totals as T
from tierwise.schemas import INVOICE
from tierwise.session import scratch_path
from tierwise.streaming import read_partials, stream_partials

DIMS = ["legal_entity", "counter_party", "tier"]


def test_stream_of_files_gives_the_same_totals(spark, tmp_path, invoices, tiers):
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    # Three files arriving, six invoices each.
    for i in range(3):
        part = INVOICE_ROWS[i * 6:(i + 1) * 6]
        (incoming / f"day{i}.csv").write_text("\n".join([INVOICE_HEADER] + part) + "\n")
    facts = (
        spark.readStream.schema(INVOICE).option("header", True).option("maxFilesPerTrigger", 1).csv(str(incoming))
    )
    partials_path = scratch_path(spark, "stream-partials-out")
    checkpoint = scratch_path(spark, "stream-ckpt")
    query = stream_partials(
        facts, tiers, "counter_party", DIMS, invoice_metrics(), partials_path, checkpoint=checkpoint, available_now=True
    )
    query.awaitTermination(120)
    assert query.exception() is None
    stored = read_partials(spark, partials_path)
    assert spark.read.parquet(partials_path).select("batch_id").distinct().count() == 3
    got = T.totals_from_partials(stored, DIMS, invoice_metrics(), "cube", "total")
    whole = T.totals_over_join(invoices, tiers, "counter_party", DIMS, invoice_metrics(), "cube", "total")
    assert rows(got) == rows(whole)

    # Restarting on the same checkpoint finds nothing new and rewrites nothing.
    again = stream_partials(
        facts, tiers, "counter_party", DIMS, invoice_metrics(), partials_path, checkpoint=checkpoint, available_now=True
    )
    again.awaitTermination(120)
    assert rows(T.totals_from_partials(read_partials(spark, partials_path), DIMS, invoice_metrics(), "cube", "total")) == rows(whole)


def test_a_stream_stopped_and_started_again_counts_nothing_twice(spark, tmp_path, data_dir):
    import pytest

    from tierwise import cli

    incoming, out = tmp_path / "landing", scratch_path(spark, "stream-restart")
    incoming.mkdir()
    run = ["stream", "--incoming", str(incoming), "--dictionary", str(data_dir / "tiers.csv"), "--out", out, "--once"]
    total = lambda: rows(cli.run(["totals", "--partials", out, "--sets", "cube", "--label", "total"], spark))
    (incoming / "day0.csv").write_text("\n".join([INVOICE_HEADER] + INVOICE_ROWS[:9]) + "\n")
    cli.run(run, spark)
    first = total()
    cli.run(run, spark)  # no checkpoint named, nothing new has arrived
    assert total() == first
    (incoming / "day1.csv").write_text("\n".join([INVOICE_HEADER] + INVOICE_ROWS[9:]) + "\n")
    cli.run(run, spark)
    whole = cli.run(["totals", "--facts", str(data_dir / "invoices.csv"), "--dictionary", str(data_dir / "tiers.csv"), "--sets", "cube", "--label", "total"], spark)
    assert total() == rows(whole)
    with pytest.raises(ValueError):  # another checkpoint would number and count the batches anew
        cli.run([*run, "--checkpoint", scratch_path(spark, "other-checkpoint")], spark)
