"""Match positions of a regular expression with built-in functions only.

Spark gives the matches of a pattern and the text between them, not their places.  A match starts
where the pieces and matches before it end, so the places are running sums of lengths.  Positions
count code points from 0; the end is exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Lengths are summed in blocks of this many, so a text with many matches costs far less than their square.
BLOCK = 256
#: Characters on either side of a match, up to the next match of the same pattern, that count as its context.
CONTEXT = 40

SPAN = "array<struct<start:int,end:int,match:string,before:string,after:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)


def located(text: Column, pattern: str, possible: Column | None = None) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` in ``text`` in order, as ``SPAN``.

    ``pattern`` must not match the empty string.  ``possible`` is a cheap condition without which
    there is no match.  NULL text has no matches.
    """

    def places(found: Column) -> Column:
        matches, pieces = found["matches"], found["pieces"]
        lengths = F.transform(matches, lambda m, i: F.length(m) + F.length(F.get(pieces, i)))   # of piece i and match i

        def with_blocks(sizes: Column) -> Column:
            blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int")),
                                 lambda b: _total(F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK))))

            def with_starts(starts: Column) -> Column:
                def span(m: Column, i: Column) -> Column:
                    block = F.floor(i / BLOCK).cast("int")
                    end = F.get(starts, block) + _total(F.slice(sizes, block * BLOCK + 1, i - block * BLOCK + 1))
                    return F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("match"),
                                    F.right(F.get(pieces, i), F.lit(CONTEXT)).alias("before"), F.left(F.get(pieces, i + 1), F.lit(CONTEXT)).alias("after"))

                return F.transform(matches, span)

            return let(F.aggregate(blocks, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.get(a, F.size(a) - 1) + x))), with_starts)

        return let(lengths, with_blocks)

    hit = text.rlike(pattern) if possible is None else possible & text.rlike(pattern)
    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"), F.split(text, pattern, -1).alias("pieces"))
    return F.when(hit, let(found, places)).otherwise(F.array().cast(SPAN))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined in array order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
