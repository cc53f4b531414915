"""Command line: the exercise's jobs over delimited or JSON files.

    python -m tierwise totals    --facts F --dictionary D [--sets cube --label total] [--out DIR]
    python -m tierwise by-status --facts F --dictionary D [--out DIR]
    python -m tierwise summary   --facts F --dictionary D [--out DIR]
    python -m tierwise detail    --facts F --dictionary D [--out DIR]
    python -m tierwise validate  --facts F [--out DIR]
    python -m tierwise partials  --facts F --dictionary D --out DIR       (a batch's partial rows, parquet)
    python -m tierwise totals    --partials DIR[,DIR...] [--sets ...]     (totals from stored batches)
    python -m tierwise stream    --incoming DIR --dictionary D --out DIR [--once]  (arriving files → partials)

Inputs are read with the declared invoice and tier schemas (``--infer`` to
infer instead); a dictionary ending in ``.json`` is read as an array of
records. Without ``--out`` the first rows are printed.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sinks
from .functions.metrics import count_rows, max_of, metric_set, sum_of
from .operators import quality
from .operators.totals import SHAPES, group_over_join, partial_totals, totals_from_partials, totals_over_join
from .plans.pipeline import ENTITY_METRICS, validated_rows
from .schemas import INVOICE, TIER
from .session import configure
from .sources import files
from .streaming.partials import BATCH_COLUMN, read_partials, stream_partials


def _read_facts(spark, args) -> DataFrame:
    return files.read_csv(spark, args.facts, None if args.infer else INVOICE, infer=args.infer)


def _read_dictionary(spark, args) -> DataFrame:
    if args.dictionary.endswith(".json"):
        return files.read_json_records(spark, args.dictionary, None if args.infer else TIER)
    return files.read_csv(spark, args.dictionary, None if args.infer else TIER, infer=args.infer)


def _emit(df: DataFrame, args) -> None:
    if args.sort:
        # A global sort for reading; totals outputs are small.
        df = df.orderBy(*[c for c in df.columns[:3]])
    if args.out and args.format == "csv":
        sinks.write_csv(df, args.out, mode=args.mode)
    elif args.out:
        sinks.write_table(df, args.out, format=args.format, mode=args.mode)
    else:
        sinks.show(df, args.rows, truncate=False)


# Arguments each command needs, checked before any Spark work starts.
_REQUIRED = {
    "partials": ("facts", "dictionary", "out"),
    "stream": ("incoming", "dictionary", "out"),
    "by-status": ("facts", "dictionary"),
    "summary": ("facts", "dictionary"),
    "detail": ("facts", "dictionary"),
    "validate": ("facts",),
}


def _rules(p: argparse.ArgumentParser, allow: list[str]) -> dict:
    rules = {}
    for item in allow:
        field, sep, values = item.partition("=")
        if not sep or field not in INVOICE.fieldNames():
            p.error(f"--allow expects FIELD=V1,V2 with a field of the invoice record, got {item!r}")
        rules[field] = F.col(field).isin(*values.split(","))
    return rules


def _check_args(p: argparse.ArgumentParser, args) -> None:
    if args.command == "totals":
        if not args.partials and not (args.facts and args.dictionary):
            p.error("totals needs --facts and --dictionary, or --partials")
        return
    missing = [f"--{name}" for name in _REQUIRED[args.command] if not getattr(args, name)]
    if missing:
        p.error(f"{args.command} needs {', '.join(missing)}")


def run(argv=None, spark: SparkSession | None = None) -> DataFrame:
    p = argparse.ArgumentParser(prog="tierwise", description=__doc__.split("\n\n")[0])
    p.add_argument("command", choices=["totals", "by-status", "summary", "detail", "validate", "partials", "stream"])
    p.add_argument("--incoming", help="folder the stream command watches for fact files")
    p.add_argument("--once", action="store_true", help="stream: process the files present, then stop")
    p.add_argument("--checkpoint", help="stream: checkpoint folder (default: _checkpoint below --out)")
    p.add_argument("--facts")
    p.add_argument("--partials", help="comma-separated folders written by the partials command")
    p.add_argument("--dictionary")
    p.add_argument("--on", default="counter_party")
    p.add_argument("--dims", default="legal_entity,counter_party,tier")
    p.add_argument("--sets", default="pairs", choices=SHAPES)
    p.add_argument("--label", default="count", choices=["count", "total", "null"])
    p.add_argument("--statuses", default="ARAP,ACCR")
    p.add_argument("--infer", action="store_true")
    p.add_argument("--validate", action="store_true", help="drop invalid fact rows before the totals")
    p.add_argument("--rejects", help="validate, or totals --validate: also write the reject table here")
    p.add_argument("--allow", action="append", default=[], metavar="FIELD=V1,V2",
                   help="validation: the values a text field may take (repeatable)")
    p.add_argument("--out")
    p.add_argument("--mode", default="errorifexists")
    p.add_argument("--format", default="csv", choices=["csv", "parquet", "json"], help="format of --out")
    p.add_argument("--rows", type=int, default=20)
    p.add_argument("--sort", action="store_true", help="order the output by its leading columns")
    args = p.parse_args(argv)
    _check_args(p, args)

    spark = spark or SparkSession.builder.appName("tierwise").getOrCreate()
    configure(spark)
    dims = args.dims.split(",")
    statuses = args.statuses.split(",")

    if args.command == "stream":
        facts = spark.readStream.schema(INVOICE).option("header", True).csv(args.incoming)
        metrics = metric_set("rating", "value", "status", *statuses)
        query = stream_partials(
            facts, _read_dictionary(spark, args), args.on, dims, metrics, args.out, checkpoint=args.checkpoint,
            available_now=args.once,
        )
        query.awaitTermination()  # with --once the stream stops by itself; otherwise it runs until stopped
        return read_partials(spark, args.out)
    if args.command == "totals" and args.partials:
        metrics = metric_set("rating", "value", "status", *statuses)
        stored = spark.read.parquet(*args.partials.split(",")).drop(BATCH_COLUMN)
        out = totals_from_partials(stored, dims, metrics, args.sets, args.label)
        _emit(out, args)
        return out
    rules = _rules(p, args.allow)
    if args.command == "validate":
        raw = files.read_csv_tolerant(spark, args.facts, INVOICE)
        good = raw.filter(F.col(files.EXTRA).isNull()).drop(files.EXTRA)
        checked = quality.validate(quality.with_position(good), INVOICE, rules)
        if args.rejects:
            # One row per failing field: position, invoice id, column, raw value, reason.
            sinks.write_csv(quality.rejects(checked, ["position", "invoice_id"]), args.rejects, mode=args.mode)
        out = quality.invalid_rows(checked, ["position", "invoice_id"])
    else:
        dictionary = _read_dictionary(spark, args)
        if args.validate:
            facts, rejected, _ = validated_rows(spark, args.facts, INVOICE, rules)
            if args.rejects:
                sinks.write_csv(rejected, args.rejects, mode=args.mode)
        else:
            facts = _read_facts(spark, args)
        if args.command == "partials":
            metrics = metric_set("rating", "value", "status", *statuses)
            out = partial_totals(facts, dictionary, args.on, dims, metrics)
            sinks.write_parquet(out, args.out, mode=args.mode)
            return out
        if args.command == "totals":
            metrics = metric_set("rating", "value", "status", *statuses)
            out = totals_over_join(facts, dictionary, args.on, dims, metrics, args.sets, args.label)
        elif args.command == "by-status":
            metrics = [count_rows("n_rows"), max_of("rating", "max_rating"), sum_of("value", "sum_value")]
            out = totals_over_join(
                facts.filter(F.col("status").isin(*statuses)), dictionary, args.on, dims, metrics, args.sets, "null",
                keys=["status"], grouping_id="grouping_id",
            )
        elif args.command == "detail":
            # One line per (legal_entity, counter_party): tier, max rating and
            # the status sums, fields separated by eleven spaces.
            metrics = [max_of("tier", "tier"), *metric_set("rating", "value", "status", *statuses)]
            per_pair = group_over_join(facts, dictionary, args.on, ["legal_entity", "counter_party"], metrics)
            lines = sinks.format_lines(per_pair, ["legal_entity", "counter_party", *[m.name for m in metrics]])
            if args.out:
                sinks.write_lines(lines, args.out, mode=args.mode)
            else:
                sinks.show(lines, args.rows, truncate=False)
            return lines
        else:
            # Same result as merging then summarising, aggregated before the join.
            out = group_over_join(facts, dictionary, args.on, ["legal_entity", "counter_party"], ENTITY_METRICS)
    _emit(out, args)
    return out


def main() -> None:
    run(sys.argv[1:])


if __name__ == "__main__":
    main()
