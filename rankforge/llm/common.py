"""Shared helpers: fresh column names, shared scratch tables, batch word codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from rankforge.session import scratch_path

#: Bytes of text that one vectorised step handles at once; a longer text is a step of its own.
STEP_BYTES = 2 << 20


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Column names that ``df`` lacks, one for each base (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for base in bases:
        name = base
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()``, and keeps column pruning and size
    estimates for what follows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def steps(texts: pa.Array, step_bytes: int = STEP_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) pieces of about ``step_bytes``; nulls become empty."""
    if not len(texts):
        return
    texts = texts.fill_null(pa.scalar("", texts.type))
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        base = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, base + step_bytes, side="right")))
        yield start, texts.slice(start, end - start)
        start = end


def word_codes(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Words between ASCII white space as codes into the distinct words.

    Returns (codes of all words, distinct words, offsets): the words of text i
    are ``codes[offsets[i]:offsets[i + 1]]``.
    """
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)))
    ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False),
                                          dtype=np.int64)))
    coded = flat.filter(full).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist(), kept[ends]


def word_dictionary(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """``word_codes`` with the distinct words as an Arrow array."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)))
    ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False),
                                          dtype=np.int64)))
    coded = (flat if kept[-1] == len(flat) else flat.filter(full)).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, kept[ends]


def strings(values: pa.Array) -> list[str]:
    """A string array without nulls as a list."""
    return values.to_numpy(zero_copy_only=False).tolist()
