"""Multi-level business totals on Spark DataFrames.

Typical use::

    from tierwise import read_csv, totals_over_join, invoice_metrics, INVOICE, TIER

    facts = read_csv(spark, "invoices/", INVOICE)
    tiers = read_csv(spark, "tiers/", TIER)
    out = totals_over_join(facts, tiers, "counter_party",
                           ["legal_entity", "counter_party", "tier"],
                           invoice_metrics(), sets="cube", label="total")
    write_csv(out, "totals/")
"""

from .functions.metrics import (
    Metric,
    count_of,
    count_rows,
    invoice_metrics,
    max_of,
    metric_set,
    min_of,
    sum_if,
    sum_of,
)
from .operators.combine import Combiner, combine_by, second_moment
from .operators.fanout import fan_out
from .operators.joins import (
    checked_broadcast,
    enrich,
    first_by,
    hot_keys,
    key_filter,
    keys_in_dictionary,
    lookup,
    merge_right_wins,
    missing_keys,
    require_keys,
)
from .operators.lattice import totals_by_lattice
from .operators.numbering import running_sum
from .operators.quality import invalid_rows, rejects, valid_rows, validate, with_position
from .operators.reshape import read_flat_records, records_from_cells, split_endless_line
from .operators.reuse import materialize
from .operators.totals import (
    compact_partials,
    grand_total,
    group_metrics,
    group_over_join,
    grouping_sets,
    partial_totals,
    totals,
    totals_from_partials,
    totals_over_join,
    totals_union,
)
from .plans.pipeline import Pipeline, entity_summary, validated_rows, validated_totals
from .plans.report import reported_run
from .schemas import INVOICE, TIER
from .session import configure, local_session
from .sinks import format_lines, replace_partitions, show, write_csv, write_lines, write_parquet, write_table
from .sources.files import read_csv, read_csv_multiline, read_csv_tolerant, read_json_lines, read_json_records, split_corrupt
from .sources.tables import read_table, register_views

__all__ = [name for name in dir() if not name.startswith("_")]
