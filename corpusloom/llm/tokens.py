"""Token counts with a public tokenizer whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tokenizer:
    """A byte-level BPE vocabulary as ranks (one "base64 rank" a line) and its pattern of words; the file must lie at ``path`` on every machine."""

    path: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    pattern: str = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def load(tokenizer: Tokenizer):
    import tiktoken

    with open(tokenizer.path, "rb") as file:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}
    return tiktoken.Encoding("public", pat_str=tokenizer.pattern, mergeable_ranks=ranks, special_tokens={})


def count_tokens(texts: DataFrame, key: str, text: str, tokenizer: Tokenizer = Tokenizer(), *carry: str) -> DataFrame:
    """(key, carried columns, tokens); NULL text has none."""
    source = texts.select(F.col(key).alias("key"), *[F.col(c) for c in carry], F.col(text).alias("text"))
    schema = source.drop("text").withColumn("tokens", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load(tokenizer).encode_ordinary
        for batch in batches:
            counts = [len(encode(t)) if t else 0 for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts, pa.int64())], names=[*batch.schema.names[:-1], "tokens"])

    return source.mapInArrow(run, schema)
