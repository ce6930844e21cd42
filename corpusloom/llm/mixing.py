"""Mixing sources to target weights by entropy balancing.

Among all document rates between 0 and a source's ``max_repeats`` that give every source its target tokens, the one nearest to "each document
once" in relative entropy has the form ``min(max_repeats, exp(lambda * tokens))`` with one multiplier a source. The multipliers solve a convex
dual; each Newton step takes gradient and curvature from one distributed aggregation, and a bracket around every root keeps the steps safe.
The rates are then rounded into whole copies by a hash of the document, and a second aggregation shifts the rounding threshold of each source, from its
longest documents to its shortest, so that the tokens of the copies meet the target.

A source is *short* if its dual has no finite solution: the steps end with every document at its cap and tokens still missing.

Scale: iterations run on counts by (source, tokens), not on documents; the driver holds a few numbers for each source of ``mix_targets``, which are joined
to the rows (broadcast up to ``BROADCAST_ROWS`` rows). Thresholds are found from at most ``BUCKETS`` sums a source and class of lengths.
A source with a third of all documents is pre-aggregated map-side like any other.

Defined results: documents whose source is not a target take no part; NULL and empty texts take part with 0 tokens and get one copy; a source
without documents is reported with share 0 and is short if it should have any; a source that cannot reach its share uses every document ``max_repeats`` times and is marked short;
a repeated row counts as a document of its own; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import materialize, release

BROADCAST_ROWS = 100_000
BUCKETS = 4096
STEPS = 60
TOLERANCE = 1e-9


def clean_source(source: Column) -> Column:
    """Trimmed, lower case, '-' and space read as '_'."""
    trimmed = F.regexp_replace(source, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    return F.translate(F.lower(trimmed), "- ", "__")


@dataclass
class Mix:
    """``copies`` (key, source, tokens, rate, copies), ``report`` (one row a target source)."""

    copies: DataFrame
    report: DataFrame


def _table(spark: SparkSession, columns: dict[str, list], types: dict[str, pa.DataType]) -> DataFrame:
    """A small table of one row a source."""
    table = spark.createDataFrame(pa.table({k: pa.array(v, types[k]) for k, v in columns.items()}))
    return F.broadcast(table) if len(columns["source"]) <= BROADCAST_ROWS else table


_TYPES = {"source": pa.string(), "lam": pa.float64(), "cap": pa.float64(), "goal": pa.float64(), "short": pa.bool_()}


def _rate(tokens: Column, scale: float) -> Column:
    """exp(lam * tokens), at most the cap; a source with a goal or a cap of 0 gives nothing, a short one all it has."""
    power = F.least(F.col("lam") * tokens / F.lit(scale), F.log("cap"))
    return F.when((F.col("cap") > 0) & (F.col("goal") > 0), F.when(F.col("short"), F.col("cap")).otherwise(F.exp(power))).otherwise(0.0)


def balance(histogram: DataFrame, goal: dict[str, float], cap: dict[str, float], scale: float) -> tuple[dict[str, float], set[str]]:
    """The multiplier of each source in ``goal`` (tokens to reach), by Newton steps on the dual, and the sources whose dual has no solution.

    ``histogram`` (source, tokens, n). A source of which no row came, or whose documents are all at the cap with tokens missing, is short.
    """
    lam = dict.fromkeys(goal, 0.0)
    low, high = dict.fromkeys(goal, -math.inf), dict.fromkeys(goal, math.inf)
    open_ = {s for s, t in goal.items() if t > 0}
    short: set[str] = set()
    x = F.col("tokens") / F.lit(scale)
    for _ in range(STEPS):
        if not open_:
            break
        names = sorted(open_)
        now = _table(histogram.sparkSession, {"source": names, "lam": [lam[s] for s in names], "cap": [max(cap[s], 0.0) for s in names]}, _TYPES)
        power, limit = F.col("lam") * x, F.when(F.col("cap") > 0, F.log("cap"))
        weighted = F.col("n") * F.coalesce(F.exp(F.least(power, limit)), F.lit(0.0)) * F.col("tokens")
        weighted = F.when(limit.isNull(), 0.0).otherwise(weighted)
        rows = histogram.join(now, "source").groupBy("source").agg(F.sum(weighted).alias("g"), F.sum(F.when(power < limit, weighted * x).otherwise(0.0)).alias("h")).collect()
        unseen = open_ - {r.source for r in rows}
        short |= unseen
        open_ -= unseen
        for r in rows:
            s, off = r.source, r.g - goal[r.source]
            if abs(off) <= TOLERANCE * goal[s]:
                open_.discard(s)
                continue
            if off < 0 and r.h == 0:  # no document is below its cap: no multiplier gives more
                short.add(s)
                open_.discard(s)
                continue
            if off > 0:
                high[s] = min(high[s], lam[s])
            else:
                low[s] = max(low[s], lam[s])
            step = lam[s] - off / r.h if r.h else math.nan
            if not (low[s] < step < high[s]):
                if math.isinf(low[s]) or math.isinf(high[s]):
                    step = lam[s] + math.copysign(max(1.0, 2 * abs(lam[s])), -off)
                else:
                    step = (low[s] + high[s]) / 2
            if step == lam[s]:
                open_.discard(s)
            lam[s] = step
    return lam, short


def mix_sources(sized: DataFrame, targets: DataFrame) -> Mix:
    """Copies of each document so that sources meet their shares. ``sized`` (key, source, tokens), ``targets`` (source, target_share, max_repeats)."""
    spark = sized.sparkSession
    wanted = targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("cap")).collect()  # the wishes themselves
    share = {r.source: float(r.share or 0) for r in wanted}
    cap = {r.source: float(max(r.cap or 0, 0)) for r in wanted}
    names = sorted(share)
    part = sized.select("key", clean_source(F.col("source")).alias("source"), "tokens").join(_table(spark, {"source": names}, _TYPES), "source", "left_semi")
    part = materialize(part, "mix-documents")
    histogram = materialize(part.groupBy("source", "tokens").agg(F.count(F.lit(1)).alias("n")), "mix-histogram")
    size = histogram.agg(F.coalesce(F.sum(F.col("tokens") * F.col("n")), F.lit(0)).alias("t"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    scale = max(size.t / size.n, 1.0) if size.n else 1.0
    goal = {s: share[s] * float(size.t) for s in names}
    lam, short = balance(histogram, goal, cap, scale)

    params = _table(spark, {"source": names, "lam": [lam[s] for s in names], "cap": [cap[s] for s in names], "goal": [goal[s] for s in names], "short": [s in short for s in names]}, _TYPES)
    # the hash is the threshold of a document; key and tokens of repeated rows are equal, so they round alike
    threshold = F.expr("pmod(xxhash64(key, 77), 1048576)") / F.lit(1048576.0)
    rated = part.join(params, "source").withColumn("rate", _rate(F.col("tokens"), scale)).withColumn("mark", F.col("rate") + threshold)
    rated = rated.withColumn("size_class", F.floor(F.log2(F.greatest("tokens", F.lit(1)))).cast("int"))
    shifts = materialize(_threshold_shifts(rated), "mix-shifts")
    shift = F.broadcast(shifts) if len(names) <= BROADCAST_ROWS // 64 else shifts  # at most 63 classes a source
    moved = F.floor(F.col("mark") + F.coalesce("shift", F.lit(0.0)))
    copies = F.when(F.col("rate") == 0, 0).when(F.col("short"), F.col("rate")).otherwise(F.least(F.greatest(moved, F.lit(0)), F.col("cap"))).cast("int")
    result = materialize(rated.join(shift, ["source", "size_class"], "left").select("key", "source", "tokens", "rate", copies.alias("copies")), "mix-copies")

    release(part, histogram, shifts)
    used = result.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("tokens"), F.sum(F.col("tokens") * F.col("copies")).alias("used_tokens"), F.max("copies").alias("most_copies"))
    plan = spark.createDataFrame([(s, share[s], int(cap[s]), goal[s], s in short) for s in names], "source string, target_share double, max_repeats int, target_tokens double, falls_short boolean")
    all_used = float(used.agg(F.sum("used_tokens")).first()[0] or 0)
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("documents", "tokens", "used_tokens", "most_copies")]
    report = plan.join(used, "source", "left")
    report = report.select("source", "target_share", "max_repeats", "target_tokens", "falls_short", *zero, (F.coalesce(F.col("used_tokens"), F.lit(0)) / F.lit(all_used or 1.0)).alias("actual_share"))
    return Mix(result, report)


def _shifts(sums: pd.DataFrame) -> pd.DataFrame:
    """Of one source, for each size class, how far to move the rounding threshold. Rows: sums by class and bucket of the mark's fraction.

    Marks just below the next whole number are moved up, or those just above one down, by whole buckets. What a class misses
    its expected tokens by is carried to the next smaller one, so that a few long documents are made up for by many short ones.
    """
    out, carry = [], 0.0
    for size in sorted(sums["size_class"].unique(), reverse=True):
        rows = sums[sums["size_class"] == size]
        off = carry + float(rows["expected"].sum() - rows["got"].sum())
        rising = off > 0
        rows = rows.sort_values("bucket", ascending=not rising)
        left = np.abs(off - np.cumsum(rows["up"] if rising else -rows["down"]))
        k = int(np.argmin(left))
        bucket = float(rows["bucket"].iloc[k])
        shift, moved = ((1 - bucket / BUCKETS) if rising else -(bucket + 1) / BUCKETS), float((rows["up"] if rising else -rows["down"]).iloc[: k + 1].sum())
        if left.iloc[k] >= abs(off):
            shift, moved = 0.0, 0.0
        carry = off - moved
        out.append(shift)
    classes = sorted(sums["size_class"].unique(), reverse=True)
    return pd.DataFrame({"source": sums["source"].iloc[0], "size_class": np.array(classes, np.int32), "shift": out})


def _threshold_shifts(rated: DataFrame) -> DataFrame:
    """(source, size_class, shift) of the sources that can meet their goal; a class holds documents of like numbers of tokens."""
    base = F.floor("mark")
    bucket = F.floor((F.col("mark") - base) * BUCKETS).cast("int")
    tokens = F.col("tokens")
    sums = rated.where(~F.col("short") & (F.col("rate") > 0)).groupBy("source", "size_class", bucket.alias("bucket")).agg(
        F.sum(F.col("rate") * tokens).alias("expected"),
        F.sum(base * tokens).cast("double").alias("got"),
        F.sum(F.when(base < F.col("cap"), tokens).otherwise(0)).cast("double").alias("up"),
        F.sum(F.when(base > 0, tokens).otherwise(0)).cast("double").alias("down"),
    )
    return sums.groupBy("source").applyInPandas(_shifts, "source string, size_class int, shift double")
