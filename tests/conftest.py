from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierwise.session import local_session  # noqa: E402

# The exercise's sample data, rows separated by a bare carriage
# return as in the original files (the invoice file ends in CR LF).
INVOICE_ROWS = [
    "1,L1,C1,1,ARAP,10", "2,L2,C2,2,ARAP,20", "3,L3,C3,4,ACCR,30", "4,L1,C4,6,ARAP,40",
    "5,L2,C5,4,ACCR,50", "6,L3,C6,6,ACCR,60", "7,L1,C1,2,ARAP,10", "8,L2,C2,3,ACCR,40",
    "9,L3,C3,3,ACCR,80", "10,L1,C4,5,ACCR,100", "11,L2,C5,6,ARAP,1000", "12,L3,C6,4,ARAP,80",
    "13,L1,C1,3,ARAP,20", "14,L2,C3,2,ACCR,52", "15,L3,C3,4,ACCR,35", "16,L1,C3,6,ARAP,5",
    "17,L2,C5,3,ACCR,65", "18,L3,C6,5,ARAP,65",
]
INVOICE_HEADER = "invoice_id,legal_entity,counter_party,rating,status,value"
TIER_ROWS = ["C1,1", "C2,2", "C3,3", "C4,4", "C5,5", "C6,6"]
TIER_HEADER = "counter_party,tier"

DIRTY_ROWS = [
    "1,L1,C1,1,ARAP,10", "2,L2,C2,2,ARAP,20", "3,L3,C3,4,ACCR,30", "4,L1,C4,6,ARAP,40", "5,L2,C5,4,ACCR,",
    "6,L3,C6,6,ACCR,60", "7,L1,C1,2,ARAP,10", "8,L2,C2,3,ACCR,40", "9,L3,C3,3,ACCR,80", "10,L1,C4,5,ACCR,100",
    "11,L2,C5,6,ARAP,1000", "12,L3,C6,4,ARAP,80", "13,L1,C1,3,ARAP,20", "14,L2,C3,2,3,52", "15,L3,C3,4,ACCR,35",
    "16,L1,C3,6,ARAP,5", "17,L2,C5,3,ACCR,65", "18,L3,C6,5,ARAP,65", "19,L3,2,6,ACCR,602", "20,L1,C1,2,ARAP,10e",
    "21,L2,C2,3,ACCR,40,1", "18,L3,C6,5,ARAP,65", "19,L3,2,6,ACCR,602", "20,L1,C1,2,ARAP,10e",
    "21,L2,C2,3,ACCR,40,1", "5,L2,C4,4,ACCR,", "6,L3,C2,6,ACCR,60",
]

TIER_JSON = """[
  {
    "counter_party": "C1",
    "tier": 1
  },
  {
    "counter_party": "C2",
    "tier": 2
  },
  {
    "counter_party": "C3",
    "tier": 3
  },
  {
    "counter_party": "C4",
    "tier": 4
  },
  {
    "counter_party": "C5",
    "tier": 5
  },
  {
    "counter_party": "C6",
    "tier": 6
  }
]"""


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", shuffle_partitions=8, app="tierwise-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("data")
    with open(d / "invoices.csv", "w", newline="") as f:
        f.write("\r".join([INVOICE_HEADER] + INVOICE_ROWS) + "\r\n")
    with open(d / "tiers.csv", "w", newline="") as f:
        f.write("\r".join([TIER_HEADER] + TIER_ROWS))
    with open(d / "invoices_dirty.csv", "w", newline="") as f:
        f.write("\r".join([INVOICE_HEADER] + DIRTY_ROWS))
    with open(d / "tiers.json", "w", newline="") as f:
        f.write(TIER_JSON)
    return d


@pytest.fixture(scope="session")
def invoices(spark, data_dir):
    from tierwise.schemas import INVOICE
    from tierwise.sources.files import read_csv

    return read_csv(spark, str(data_dir / "invoices.csv"), INVOICE)


@pytest.fixture(scope="session")
def tiers(spark, data_dir):
    from tierwise.schemas import TIER
    from tierwise.sources.files import read_csv

    return read_csv(spark, str(data_dir / "tiers.csv"), TIER)


@pytest.fixture(scope="session")
def enriched(invoices, tiers):
    from tierwise.operators.joins import enrich

    return enrich(invoices, tiers, "counter_party")


def rows(df, cols=None):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def parse(text: str, types):
    """Rows written as 'a b c; d e f' into typed tuples."""
    out = []
    for chunk in text.split(";"):
        fields = chunk.split()
        if fields:
            out.append(tuple(t(v) for t, v in zip(types, fields)))
    return sorted(out, key=repr)
