"""Mixing sources to target weights by entropy balancing: exponentially tilted document rates, rounded into copies.

Each source has a target of tokens. Among all document rates that meet the targets, the ones nearest to taking each
document once, in relative entropy, are ``min(most, exp(m * size))`` with one multiplier ``m`` for each source, a
multiplier of the dual problem. The dual is convex and falls apart by source, so Newton steps run for all sources at
once: each step is one grouping over the distinct sizes of a source, which are counted once before. Steps go by the
logarithm of the tokens; a step that leaves the interval known to hold the solution is replaced by its middle. The
number of steps is not limited: a source is settled when its tokens meet the target to ``NEAR``, or when no number lies
between the ends of its interval.

Rates are integers in units of 1 / ``UNIT``, so sums are exact and the same however rows are dealt. Documents of a
source stand in falling order of size; a document's copies are how many whole copies the running sum of rates passes at
it. At any place the copies made and the rates summed differ by half a copy at most, so the tokens of a source miss its
target by less than its longest document.

A null source is a source of its own and comes last. Null and empty texts have size 0 and rate 1. A source of size 0
has target 0. Repeated rows are documents of their own. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.base import as_arrays, by_slices, stored, utf8
from plumbline.llm.running import running

#: Parts of a copy; rates are rounded to them.
UNIT = 100_000_000
#: Tokens of a source that meet its target to this share need no further step.
NEAR = 1e-6

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def with_sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, source, size): the number of words between blanks of each whole text."""

    def count(part: pa.RecordBatch) -> pa.RecordBatch:
        data, at = as_arrays(part.column("text"))
        inside = ~_BLANK[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        first = at[:-1][at[:-1] < at[1:]]
        begins[first] = inside[first]
        total = np.concatenate([[0], np.cumsum(begins)])
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("source"), pa.array(total[at[1:]] - total[at[:-1]])], ["doc_id", "source", "size"]
        )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), utf8(text).alias("text"))
    return by_slices(rows, "text", count, "doc_id bigint, source string, size bigint")


def source_key(source: Column | str) -> Column:
    """A key without nulls that sorts by code point, null last."""
    value = F.col(source) if isinstance(source, str) else source
    return F.coalesce(F.concat(F.lit("="), value), F.lit("~"))


def targets(sizes: DataFrame, weights: Sequence[float], most: int) -> DataFrame:
    """(key, source_size, target) from (key, size): all tokens shared by weights that repeat in the order of keys.

    A target stops at ``most`` times its source's size; the excess is shared again by weight until none is above.
    """
    sources = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    one = sources.select("key", "source_size", F.lit(1).cast("bigint").alias("_one"), F.lit("").alias("_all"))
    ranked = running(one, "_all", [F.col("key").asc()], "_one", "_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    shared = stored(ranked.select("key", "source_size", weight.alias("weight")), "mix-sources")
    whole = shared.agg(F.sum("source_size").alias("n")).first()["n"]
    limit, full = F.col("source_size") * most, F.lit(False)
    settled = -1
    while True:  # a source that is full stays full, since the share of the others only grows
        row = shared.agg(
            F.count_if(full).alias("n"), F.sum(F.when(full, limit).otherwise(0)).alias("taken"), F.sum(F.when(~full, F.col("weight"))).alias("w")
        ).first()
        share = (whole - row["taken"]) / row["w"] if row["w"] else 0.0
        if row["n"] == settled or not row["w"]:
            return shared.select("key", "source_size", F.when(full, limit.cast("double")).otherwise(F.col("weight") * share).alias("target"))
        settled, full = row["n"], F.col("weight") * share >= limit


def rate(multiplier: Column, size: Column, most: int) -> Column:
    """Rate of a document in units, from the multiplier of its source."""
    return F.round(F.least(F.lit(float(most)), F.exp(multiplier * size)) * UNIT).cast("bigint")


def multipliers(sizes: DataFrame, aims: DataFrame, most: int) -> DataFrame:
    """(key, multiplier): the solution of the dual for every source of (key, size), aims (key, source_size, target)."""
    counted = stored(sizes.filter("size > 0").groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    # Full sources are at the upper end; the others lie between the point where all is taken or nothing is left.
    full = F.col("target") >= F.col("source_size") * most
    start = F.when(full, float("inf")).otherwise(F.log(F.col("target") / F.col("source_size")) * F.col("heads") / F.col("source_size"))
    heads = counted.groupBy("key").agg(F.sum("n").alias("heads"))
    state = aims.filter("source_size > 0").join(heads, "key").select(
        "key", "target", start.alias("m"), F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"), full.alias("done")
    )
    state = stored(state, "mix-multipliers")
    while not state.filter("NOT done").isEmpty():
        units = rate(F.col("m"), F.col("size"), most)
        tokens = units.cast("decimal(20,0)") * (F.col("n") * F.col("size"))
        gain = F.when(units < most * UNIT, tokens * F.col("size"))
        seen = counted.join(state.filter("NOT done").select("key", "m"), "key").groupBy("key")
        seen = seen.agg(F.sum(tokens).cast("double").alias("tokens"), F.sum(gain).cast("double").alias("gain"))
        found = state.filter("NOT done").join(seen, "key").withColumn("tokens", F.col("tokens") / UNIT).withColumn("gain", F.col("gain") / UNIT)
        over = F.col("tokens") > F.col("target")
        found = found.withColumn("low", F.when(over, F.col("low")).otherwise(F.col("m"))).withColumn("high", F.when(over, F.col("m")).otherwise(F.col("high")))
        newton = F.col("m") + F.try_divide(F.log(F.try_divide("target", "tokens")) * F.col("tokens"), F.col("gain"))
        # Without a finite end on the side of the solution, the way out doubles.
        middle = (
            F.when(F.col("low") == float("-inf"), F.least(F.col("high") * 2, -F.abs(F.col("high")) - 1e-6))
            .when(F.col("high") == float("inf"), F.greatest(F.col("low") * 2, F.abs(F.col("low")) + 1e-6))
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        found = found.withColumn("next", F.when((newton > F.col("low")) & (newton < F.col("high")), newton).otherwise(middle))
        near = F.abs(F.col("tokens") - F.col("target")) <= F.col("target") * NEAR
        stuck = (F.col("next") == F.col("low")) | (F.col("next") == F.col("high"))
        stepped = found.select("key", "target", F.when(near, F.col("m")).otherwise(F.col("next")).alias("m"), "low", "high", (near | stuck).alias("done"))
        state = stored(state.filter("done").unionByName(stepped), "mix-multipliers")
    return state.select("key", F.col("m").alias("multiplier"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most: int = 3) -> DataFrame:
    """Copies of each of ``docs`` (doc_id, source, text): doc_id, source, size, source_size, target, rate, copies, taken."""
    rows = stored(with_sizes(docs).withColumn("key", source_key("source")), "mix-rows")
    aims = stored(targets(rows, weights, most), "mix-targets")
    solved = multipliers(rows.select("key", "size"), aims, most)
    units = F.when(F.col("size") > 0, rate(F.col("multiplier"), F.col("size"), most)).otherwise(UNIT)
    rated = rows.join(aims.join(solved, "key", "left"), "key").withColumn("_units", units)
    order = [F.col("size").desc(), F.col("doc_id").asc_nulls_last()]
    summed = running(rated.drop("multiplier"), "key", order, "_units", "_sum")
    copies = F.expr(f"(_sum + _units + {UNIT // 2}) div {UNIT} - (_sum + {UNIT // 2}) div {UNIT}")
    found = summed.withColumn("copies", copies).withColumn("rate", F.col("_units") / UNIT)
    return found.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))
