"""Enrichment joins of a fact table with a dictionary table.

Broadcasting: a dictionary is broadcast only behind a size check. ``"auto"``
leaves the choice to Catalyst's size estimate and to AQE, which measures the
shuffled dictionary at run time before turning a shuffle join into a broadcast
join. ``True`` first measures rows and data bytes with one aggregate and falls
back to a shuffle join when the dictionary exceeds either bound. ``False``
never broadcasts.

Skew: with a shuffle join, one key may hold a large share of the fact rows.
AQE's skew-join handling splits such partitions by itself; ``salt`` makes it
explicit. A dictionary that passes the size check is broadcast, which needs no
salt. Otherwise one aggregate counts the fact rows per key (stored once in the
shared checkpoint folder); keys with at least ``hot_rows`` rows (or
``hot_fraction`` of all rows) are hot, and the bound rises by itself so that
never more than ``max_hot_keys`` keys are. The hot keys' fact rows are spread
over ``salt`` buckets by a hash of the row, and only those keys' dictionary rows
are copied into every bucket. Rows whose key is null and cannot match stay out
of the shuffle.

Key filter: an inner or semi join that must shuffle moves fact rows that match
nothing, too. ``bloom=True`` builds a Bloom filter of the dictionary's keys (one
aggregate of the dictionary, at most ``max_bits`` bits whatever its size) and applies
it as a column expression in the fact's scan stage: of the unmatched rows only the
filter's false positives reach the shuffle. It never changes a result.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest dictionary, in rows and in bytes of data, that ``broadcast=True``
# will send to every executor.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024

# Fixed widths, in bytes, used to size values of non-text types.
_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
    T.FloatType: 4, T.DoubleType: 8, T.DecimalType: 16, T.DateType: 4, T.TimestampType: 8,
}


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _value_bytes(field: T.StructField):
    c = F.col(field.name)
    for kind, width in _FIXED_WIDTH.items():
        if isinstance(field.dataType, kind):
            return F.lit(width)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))  # nested values, by their JSON size


def measure(df: DataFrame) -> tuple[int, int]:
    """``(rows, data bytes)`` of ``df``: one aggregate, one row per task to the driver."""
    width = None
    for field in df.schema.fields:
        w = _value_bytes(field)
        width = w if width is None else width + w
    row = df.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width if width is not None else F.lit(0)), F.lit(0)).alias("b")
    ).first()
    return int(row["n"]), int(row["b"])


def fits(df: DataFrame, max_rows: int, max_bytes: int | None = None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes of data."""
    n, size = measure(df)
    return n <= max_rows and (max_bytes is None or size <= max_bytes)


def checked_broadcast(
    df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES
) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` if both size bounds hold, else ``(df, False)``."""
    if fits(df, max_rows, max_bytes):
        return F.broadcast(df), True
    return df, False


def _prepare(dictionary: DataFrame, broadcast, max_rows: int) -> DataFrame:
    if broadcast == "auto":
        return dictionary
    if broadcast is True:
        return checked_broadcast(dictionary, max_rows)[0]
    if broadcast is False:
        return dictionary
    raise ValueError("broadcast must be 'auto', True or False")


def enrich(
    fact: DataFrame,
    dictionary: DataFrame,
    on,
    how: str = "inner",
    null_safe: bool = False,
    broadcast="auto",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    strict: bool = False,
    salt: int = 0,
    hot_rows: int = 1_000_000,
    max_hot_keys: int | None = None,
    hot_fraction: float | None = None,
    bloom: bool = False,
) -> DataFrame:
    """Equi-join ``fact`` with ``dictionary`` on shared key names.

    Null keys never match under SQL rules; ``null_safe=True`` makes a null key
    match a null key. ``strict=True`` raises when a fact key is absent from the
    dictionary: an extra pass (an anti join over the distinct fact keys, whose
    map side keeps one row per key) names up to ten missing keys.
    Output: key columns once, then the other fact columns, then the other
    dictionary columns.
    """
    keys = _keys(on)
    if strict:
        require_keys(fact, dictionary, keys, null_safe=null_safe)
    if salt and salt > 1:
        if how not in ("inner", "left", "left_outer"):
            raise ValueError("salting is implemented for inner and left joins")
        fitted, small = checked_broadcast(dictionary, max_broadcast_rows) if broadcast is not False else (dictionary, False)
        if not small:
            return _salted_join(
                fact, dictionary, keys, salt, hot_rows, max_hot_keys or DEFAULT_MAX_HOT_KEYS, null_safe, how, hot_fraction
            )
        dictionary, broadcast = fitted, "auto"
    right = _prepare(dictionary, broadcast, max_broadcast_rows)
    if bloom and how == "inner" and not null_safe:
        fact = key_filter(fact, dictionary, keys)
    if not null_safe:
        return fact.join(right, keys, how)
    if how not in ("inner", "left", "left_outer"):
        raise ValueError("null-safe enrichment supports inner and left joins")
    cond = None
    for k in keys:
        c = fact[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return fact.join(right, cond, how).select(
        *[fact[k] for k in keys],
        *[fact[c] for c in fact.columns if c not in keys],
        *[right[c] for c in dictionary.columns if c not in keys],
    )


# Most bits of a key filter (16 MiB).
DEFAULT_MAX_FILTER_BITS = 1 << 27
_HASHABLE = (T.IntegralType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.DecimalType)


def _filter_places(columns, bits: int, hashes: int):
    """Bit positions of a key: two hashes, combined ``hashes`` times."""
    one, two = (F.pmod(h, F.lit(bits)) for h in (F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)))
    return [F.pmod(one + i * two, F.lit(bits)) for i in range(hashes)]


def key_filter(
    fact: DataFrame, dictionary: DataFrame, on, false_positives: float = 0.01, max_bits: int = DEFAULT_MAX_FILTER_BITS
) -> DataFrame:
    """``fact`` without most rows whose key is null or not in ``dictionary``.

    The filter's words are one array value of at most ``max_bits`` bits, made by an
    aggregate that ors the keys' bits per word, and reach the scan as a scalar
    subquery. Beyond ``max_bits`` it lets more rows pass, never fewer. Key columns
    whose types differ on the two sides, or that are floating point, nested or
    collated, leave the fact as it is.
    """
    keys = _keys(on)
    kinds = [(fact.schema[k].dataType, dictionary.schema[k].dataType) for k in keys]
    if any(a != b or not isinstance(a, _HASHABLE) or getattr(a, "collation", "UTF8_BINARY") != "UTF8_BINARY" for a, b in kinds):
        return fact
    from .reuse import materialize

    known = dictionary.select(*keys).dropna()
    count = max(1, known.agg(F.approx_count_distinct(F.struct(*keys))).first()[0])
    bits = 64 * math.ceil(min(max_bits, max(1024, -count * math.log(false_positives) / math.log(2) ** 2)) / 64)
    hashes = max(1, min(8, round(bits / count * math.log(2))))
    places = known.select(F.explode(F.array(*_filter_places([F.col(k) for k in keys], bits, hashes))).alias("place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("place") % 64).cast("int"))
    words = places.groupBy(F.floor(F.col("place") / 64).alias("word")).agg(F.bit_or(bit).alias("bits"))
    every = dictionary.sparkSession.range(bits // 64).withColumnRenamed("id", "word").join(words, "word", "left")
    packed = every.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits")))), lambda w: w["bits"]).alias("words"))
    array = materialize(packed, "checkpoint").scalar()
    passes = F.lit(True)
    for k in keys:
        passes = passes & F.col(k).isNotNull()
    for place in _filter_places([F.col(k) for k in keys], bits, hashes):
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))
        passes = passes & (F.get(array, F.floor(place / 64).cast("int")).bitwiseAND(bit) != 0)
    return fact.filter(passes)


def keys_in_dictionary(
    fact: DataFrame, dictionary: DataFrame, on, broadcast="auto", max_broadcast_rows=DEFAULT_MAX_BROADCAST_ROWS, bloom: bool = False
) -> DataFrame:
    """Fact rows whose key exists in the dictionary; dictionary columns are not added
    and duplicate dictionary keys do not multiply rows (a left semi join). With
    ``bloom`` the keys' Bloom filter drops most other rows before a shuffle."""
    keys = _keys(on)
    if bloom:
        fact = key_filter(fact, dictionary, keys)
    right = _prepare(dictionary.select(*keys), broadcast, max_broadcast_rows)
    return fact.join(right, keys, "left_semi")


def missing_keys(fact: DataFrame, dictionary: DataFrame, on, null_safe: bool = False) -> DataFrame:
    """Distinct fact keys with no dictionary row."""
    keys = _keys(on)
    # Distinct first: the map-side aggregate leaves one row per key, so the
    # anti join sees keys, not fact rows (a hot key costs nothing extra).
    left = fact.select(*keys).distinct()
    right = dictionary.select(*keys)
    if null_safe:
        cond = None
        for k in keys:
            c = left[k].eqNullSafe(right[k])
            cond = c if cond is None else cond & c
        return left.join(right, cond, "left_anti")
    return left.join(right, keys, "left_anti")


class MissingKeyError(ValueError):
    """Names some missing keys; ``missing_keys`` is the DataFrame of all of them."""

    def __init__(self, message: str, missing: DataFrame | None = None):
        super().__init__(message)
        self.missing_keys = missing


def require_keys(fact: DataFrame, dictionary: DataFrame, on, null_safe: bool = False, show: int = 10) -> None:
    """Raise ``MissingKeyError`` naming up to ``show`` fact keys the dictionary lacks;
    its ``missing_keys`` holds them all."""
    missing = missing_keys(fact, dictionary, on, null_safe)
    sample = missing.limit(show).collect()
    if sample:
        raise MissingKeyError(f"dictionary lacks keys for fact rows, e.g. {[tuple(r) for r in sample]}", missing)


def first_by(dictionary: DataFrame, on, order_by: Sequence[str] | str) -> DataFrame:
    """One dictionary row per key: the row with the smallest ``order_by`` values, nulls last.

    Ties on ``order_by`` are broken by the remaining columns, so the choice is
    deterministic. Runs as a partial and final aggregate of ``min(struct(...))``
    (Spark plans it as a sort aggregate, which spills): map tasks keep one
    candidate per key before the shuffle, so a key with a huge number of
    duplicates is reduced where it is read, not in one reduce task.
    """
    keys = _keys(on)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    if set(order) & set(keys):
        raise ValueError("order_by must name columns other than the key: within a key the key is constant")
    rest = [c for c in dictionary.columns if c not in keys and c not in order]
    # A flag before each value puts nulls last, as SQL's default order does.
    ranked = [p for c in order + rest for p in (F.col(c).isNull().alias(f"__n_{c}"), F.col(c))]
    best = dictionary.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.{c}").alias(c) for c in order + rest]).select(*dictionary.columns)


def lookup(
    fact: DataFrame,
    dictionary: DataFrame,
    on,
    order_by,
    broadcast="auto",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    strict: bool = False,
) -> DataFrame:
    """Side-input style lookup: a dictionary with unique keys, fact rows without
    a match dropped. Duplicate dictionary keys keep the first row by ``order_by``."""
    unique = first_by(dictionary, on, order_by)
    return enrich(fact, unique, on, "inner", broadcast=broadcast, max_broadcast_rows=max_broadcast_rows, strict=strict)


def merge_right_wins(
    fact: DataFrame,
    dictionary: DataFrame,
    on,
    order_by,
    broadcast="auto",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    strict: bool = False,
) -> DataFrame:
    """Co-group style merge: each fact row takes the first dictionary row of its
    key (by ``order_by``); on column names both sides share, the dictionary's
    value wins. Dictionary keys without fact rows produce nothing."""
    keys = _keys(on)
    unique = first_by(dictionary, keys, order_by)
    renamed = unique.select(*keys, *[F.col(c).alias(f"__r_{c}") for c in unique.columns if c not in keys])
    joined = enrich(
        fact, renamed, keys, "inner", broadcast=broadcast, max_broadcast_rows=max_broadcast_rows, strict=strict
    )
    shared = set(fact.columns) & set(dictionary.columns)
    out = [F.col(k) for k in keys]
    for c in fact.columns:
        if c in keys:
            continue
        out.append(F.col(f"__r_{c}").alias(c) if c in shared else F.col(c))
    for c in dictionary.columns:
        if c not in keys and c not in shared:
            out.append(F.col(f"__r_{c}").alias(c))
    return joined.select(*out)


def hot_keys(fact: DataFrame, on, hot_rows: int) -> DataFrame:
    """Keys carrying at least ``hot_rows`` fact rows, found exactly by an aggregate
    (partial counts per map task, so the hot keys themselves are cheap to count)."""
    keys = _keys(on)
    return fact.groupBy(*keys).count().filter(F.col("count") >= hot_rows).select(*keys)


# Most hot keys the salted join broadcasts back into the scans; the bound on rows
# rises until no more keys than that are hot.
DEFAULT_MAX_HOT_KEYS = 100_000


def _null_safe_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Plain-equality stand-ins for null-safe keys: each key becomes
    (its value or a typed default, whether it is null), as Spark itself plans
    a ``<=>`` join key."""
    out = []
    for i, k in enumerate(keys):
        dtype = df.schema[k].dataType
        if isinstance(dtype, T.StringType):
            default = F.lit("")
        elif isinstance(dtype, T.NumericType):
            default = F.lit(0).cast(dtype)
        elif isinstance(dtype, T.BooleanType):
            default = F.lit(False)
        else:
            raise ValueError(f"null-safe salting does not support key type {dtype.simpleString()}")
        df = df.withColumn(f"__k{i}", F.coalesce(F.col(k), default)).withColumn(f"__z{i}", F.col(k).isNull())
        out += [f"__k{i}", f"__z{i}"]
    return df, out


def _salted_join(
    fact: DataFrame, dictionary: DataFrame, keys: list[str], buckets: int, hot_rows: int,
    max_hot_keys: int = DEFAULT_MAX_HOT_KEYS, null_safe: bool = False, how: str = "inner",
    hot_fraction: float | None = None,
) -> DataFrame:
    from .reuse import materialize

    fact_cols, dict_rest = list(fact.columns), [c for c in dictionary.columns if c not in keys]
    unmatched = None
    if null_safe:
        # A null key is a key like any other here, hot or not.
        fact, join_keys = _null_safe_keys(fact, keys)
        dictionary, _ = _null_safe_keys(dictionary, keys)
        dictionary = dictionary.drop(*keys)
    else:
        join_keys = list(keys)
        whole = F.lit(True)
        for k in keys:
            whole = whole & F.col(k).isNotNull()
        if how != "inner":
            # A null key matches nothing: its rows need no shuffle.
            unmatched = fact.filter(~whole)
        fact, dictionary = fact.filter(whole), dictionary.filter(whole)
    # One pass over the fact: rows per key, stored once, give the total and the
    # hot keys. Hot means ``hot_rows`` rows or ``hot_fraction`` of all; as all
    # hot keys' rows together are no more than the total, at most
    # total / bound keys are hot, and the bound is raised to keep that in limits.
    counts = materialize(fact.groupBy(*join_keys).count(), "checkpoint")
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    bound = hot_rows if hot_fraction is None else max(1, math.ceil(hot_fraction * total))
    bound = max(bound, -(-total // max_hot_keys))
    hot = F.broadcast(counts.filter(F.col("count") >= bound).select(*join_keys, F.lit(True).alias("__hot")))
    tagged = fact.join(hot, join_keys, "left")
    # The bucket comes from a hash of the whole row, so a recomputed task puts
    # every row back into the same bucket.
    row_hash = F.xxhash64(*[F.col(c) for c in fact_cols])
    salted_fact = tagged.withColumn(
        "__salt", F.when(F.col("__hot"), F.pmod(row_hash, F.lit(buckets))).otherwise(F.lit(0).cast("bigint"))
    ).drop("__hot")
    # Only hot keys' dictionary rows are copied into every bucket.
    dict_tagged = dictionary.join(hot, join_keys, "left")
    salted_dict = dict_tagged.withColumn(
        "__salt",
        F.explode(
            F.when(F.col("__hot"), F.sequence(F.lit(0).cast("bigint"), F.lit(buckets - 1).cast("bigint"))).otherwise(
                F.array(F.lit(0).cast("bigint"))
            )
        ),
    ).drop("__hot")
    # Each fact row meets one copy of each matching dictionary row, in its own
    # bucket; a left join keeps the rows that meet none.
    joined = salted_fact.join(salted_dict, join_keys + ["__salt"], how)
    out = joined.select(*keys, *[c for c in fact_cols if c not in keys], *dict_rest)
    if unmatched is None:
        return out
    types = {f.name: f.dataType for f in dictionary.schema.fields}
    empty = [F.lit(None).cast(types[c]).alias(c) for c in dict_rest]
    return out.unionByName(unmatched.select(*keys, *[c for c in fact_cols if c not in keys], *empty))
