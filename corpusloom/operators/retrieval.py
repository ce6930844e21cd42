"""Search over the corpus: cosine top-k, token search and containment in JSON."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.vectors import cosine, usable
from corpusloom.session import materialize

#: Fixed pattern of a search token: letters and digits of any script.
TOKEN = r"[\p{L}\p{N}_]+"
QUERY_BLOCK = 20_000  # queries that are sent to every task at once


def cosine_top_k(rows: DataFrame, query: list[float], k: int, key: str = "id", vector: str = "embedding") -> DataFrame:
    """(key, similarity) of the k nearest rows; every task keeps k, so nothing is sorted as a whole."""
    target = F.array(*[F.lit(float(x)) for x in query])
    good = rows.where(usable(F.col(vector), len(query)))
    return good.select(key, cosine(F.col(vector), target).alias("similarity")).orderBy(F.desc("similarity"), key).limit(k)


def tokens(*texts: Column) -> Column:
    """Distinct lower-case tokens of the texts; no stemming and no stop words."""
    joined = F.concat_ws(" ", *texts)
    return F.array_distinct(F.regexp_extract_all(F.lower(joined), F.lit(TOKEN), F.lit(0)))


def matches_all(query: str, *texts: Column) -> Column:
    """Whether every token of the query occurs; an empty query matches nothing."""
    wanted = sorted(set(re.findall(r"\w+", query.lower())))
    return F.size(F.array_intersect(tokens(*texts), F.array(*map(F.lit, wanted)))) == len(wanted) if wanted else F.lit(False)


def json_contains(raw_json: Column, pattern: Any) -> Column:
    """Whether the document holds ``pattern`` (a value as of ``json.loads``): an object all of the pattern's fields, an array for each of the pattern's elements one that
    holds it, a scalar the same value of the same type. False where the text is no complete JSON."""
    return F.coalesce(_holds(F.try_parse_json(raw_json), pattern), F.lit(False))


def _holder(pattern: Any) -> Callable[[Column], Column]:
    return lambda value: _holds(value, pattern)


def _holds(value: Column, pattern: Any) -> Column:
    shape = F.coalesce(F.schema_of_variant(value), F.lit(""))
    if isinstance(pattern, dict):
        parts = [_holds(F.try_variant_get(value, "$[" + json.dumps(name) + "]", "variant"), v) for name, v in pattern.items()]
        return reduce(lambda a, b: a & b, parts, shape.startswith("OBJECT"))
    if isinstance(pattern, list):
        elements = F.try_variant_get(value, "$", "array<variant>")
        parts = [F.exists(elements, _holder(p)) for p in pattern]
        return reduce(lambda a, b: a & b, parts, shape.startswith("ARRAY"))
    if pattern is None:
        return F.coalesce(F.is_variant_null(value), F.lit(False))
    if isinstance(pattern, bool):
        return (shape == "BOOLEAN") & (F.try_variant_get(value, "$", "boolean") == F.lit(pattern))
    if isinstance(pattern, str):
        return (shape == "STRING") & (F.try_variant_get(value, "$", "string") == F.lit(pattern))
    return ~shape.isin("STRING", "BOOLEAN", "VOID", "") & (F.try_variant_get(value, "$", "double") == F.lit(float(pattern)))


def top_k_of_queries(queries: DataFrame, rows: DataFrame, k: int, dim: int, key: str = "id", vector: str = "embedding") -> DataFrame:
    """(query, key, similarity): for each row of ``queries`` the k nearest of ``rows``, itself included where it is there.

    The queries go to the tasks in blocks of ``QUERY_BLOCK``, one pass over the rows for each block; every task keeps k rows a query, the smaller key first among equals.
    """
    spark = rows.sparkSession
    good = lambda df: df.where(usable(F.col(vector), dim)).select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    asked, others = materialize(good(queries), "queries"), good(rows)
    name = others.schema["key"].dataType.simpleString()
    out = spark.createDataFrame([], f"query {name}, `{key}` {name}, similarity double")
    count = asked.count()
    blocks = -(-count // QUERY_BLOCK)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    for block in range(blocks):
        some = asked.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block).toArrow()  # about QUERY_BLOCK rows
        ids, targets = some.column(0), unit(np.array(some.column(1).to_pylist()).reshape(-1, dim))

        def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: pa.Table | None = None
            for batch in batches:
                x = unit(np.array(batch.column(1).to_pylist()).reshape(-1, dim))
                s = np.round(targets @ x.T, 12)
                order = np.argsort(pa.compute.rank(batch.column(0), tiebreaker="first").to_numpy())
                top = order[np.argsort(-s[:, order], axis=1, kind="stable")[:, :k]]
                at = np.repeat(np.arange(len(s)), top.shape[1])
                found = pa.table({"q": pa.array(at), "key": batch.column(0).take(pa.array(top.ravel())), "similarity": pa.array(s[at, top.ravel()])})
                best = found if best is None else pa.concat_tables([best, found])
                best = best.sort_by([("q", "ascending"), ("similarity", "descending"), ("key", "ascending")])
                q = best.column("q").to_numpy()
                head = np.r_[True, q[1:] != q[:-1]] if len(q) else np.empty(0, bool)
                rank = np.arange(len(q)) - np.maximum.accumulate(np.where(head, np.arange(len(q)), 0)) if len(q) else q
                best = best.filter(pa.array(rank < k))
            if best is not None and best.num_rows:
                named = pa.table([ids.take(best.column("q")), best.column("key"), best.column("similarity")], names=["query", key, "similarity"])
                yield from named.combine_chunks().to_batches()

        out = out.unionByName(materialize(others.mapInArrow(nearest, out.schema), "nearest"))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("similarity"), key))
    return out.withColumn("place", place).where(F.col("place") <= k).drop("place")
