"""Places of matches in long texts, as SQL over arrays, in time that grows with the text.

A running sum over an array by ``aggregate`` copies what it has so far at every
step, and ``substr`` counts from a text's beginning: both are more than linear in
a text's matches. Here sums run in blocks of ``BLOCK`` matches and over the blocks,
and texts are cut once into chunks of ``CHUNK`` code points to read contexts from.
"""

from __future__ import annotations

BLOCK = 256
CHUNK = 1024
SPAN = "struct<s:int,e:int,m:string,g:string>"


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def located_sql(text: str, pattern: str) -> str:
    """All matches of ``pattern`` (a quoted literal) in ``text``, in order: start, end, the match
    and the gap before it, in code points."""
    pieces = (
        f"zip_with(split({text}, {pattern}, -1), regexp_extract_all({text}, {pattern}, 0), "
        "(g, h) -> struct(g AS g, h AS h, length(g) AS l, coalesce(length(h), 0) AS w))"
    )
    within = (
        f"aggregate(slice(p, b * {BLOCK} + 1, {BLOCK}), struct(0 AS at, CAST(array() AS array<{SPAN}>) AS out), "
        "(acc, x) -> struct(acc.at + x.l + x.w AS at, IF(x.h IS NULL, acc.out, "
        "array_append(acc.out, struct(acc.at + x.l AS s, acc.at + x.l + x.w AS e, x.h AS m, x.g AS g))) AS out))"
    )
    return (
        f"element_at(transform(array({pieces}), p -> flatten(aggregate("
        f"transform(sequence(0, CAST((size(p) - 1) div {BLOCK} AS int)), b -> {within}), "
        f"struct(0 AS at, CAST(array() AS array<array<{SPAN}>>) AS out), "
        "(acc, x) -> struct(acc.at + x.at AS at, array_append(acc.out, "
        "transform(x.out, o -> struct(o.s + acc.at AS s, o.e + acc.at AS e, o.m AS m, o.g AS g))) AS out), "
        "acc -> acc.out))), 1)"
    )


def chunks_sql(text: str) -> str:
    """``text`` cut every ``CHUNK`` code points."""
    return f"regexp_extract_all({text}, '(?s).{{1,{CHUNK}}}', 0)"


def cut_sql(chunks: str, start: str, count: str) -> str:
    """``count`` code points, at most ``CHUNK``, from place ``start`` (0 the first) of a text in chunks."""
    here = f"coalesce(try_element_at({chunks}, CAST(({start}) div {CHUNK} AS int) + 1), '')"
    following = f"coalesce(try_element_at({chunks}, CAST(({start}) div {CHUNK} AS int) + 2), '')"
    return f"substr(concat({here}, {following}), CAST(({start}) % {CHUNK} AS int) + 1, {count})"
