"""Declared schemas of the invoice data model.

Dimension outputs of every totals plan are strings (a rolled-up column may
carry a label), so these schemas only describe inputs.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The typed invoice record: id, legal entity, counter party, rating, status, value.
INVOICE = T.StructType(
    [
        T.StructField("invoice_id", T.LongType()),
        T.StructField("legal_entity", T.StringType()),
        T.StructField("counter_party", T.StringType()),
        T.StructField("rating", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("value", T.LongType()),
    ]
)

# The tier dictionary keyed by counter party.
TIER = T.StructType(
    [
        T.StructField("counter_party", T.StringType()),
        T.StructField("tier", T.LongType()),
    ]
)


def all_strings(schema: T.StructType) -> T.StructType:
    """Same field names, every field a string: the shape of raw text before validation."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
