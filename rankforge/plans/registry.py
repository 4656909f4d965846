"""Query registry: every key pairs a Spark job with its DuckDB oracle text.

Spark side: ``fn(spark, root) -> DataFrame`` built with the DataFrame API.
Oracle side: an independent SQL text over the same parquet tables.
Double columns listed in ``doubles`` are rounded to 6 digits on both sides
so that summation order does not change the comparison hash.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.functions.columns import DIGITS


@dataclass
class Query:
    key: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: tuple[str, ...] = field(default_factory=tuple)
    ops: str = ""

    def run(self, spark: SparkSession, root: str) -> DataFrame:
        df = self.fn(spark, root)
        if self.doubles:
            df = df.select(*[F.round(F.col(f"`{c}`").cast("double"), DIGITS).alias(c)
                             if c in self.doubles else F.col(f"`{c}`") for c in df.columns])
        return df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        if not self.doubles:
            return self.sql.strip()
        rep = ", ".join(f'round(CAST("{c}" AS DOUBLE), {DIGITS}) AS "{c}"' for c in self.doubles)
        return f"SELECT * REPLACE ({rep}) FROM (\n{self.sql.strip()}\n) AS q"


REGISTRY: dict[str, Query] = {}


def register(key: str, sql: str | None = None, doubles=(), ops: str = ""):
    def deco(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, fn, sql, tuple(doubles), ops)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the modules fills REGISTRY.
    from rankforge.plans import (q_core, q_metrics, q_models, q_abtest,  # noqa: F401
                                 q_monitoring, q_streaming)
    return REGISTRY
