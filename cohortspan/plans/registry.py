"""Named queries: an adapter, a library operator, and the same rows as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .adapters import cte, frame

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Integers as long and doubles rounded to 6 digits, so both engines' rows compare."""
    cast = {"int": lambda c: c.cast("long"), "smallint": lambda c: c.cast("long"), "tinyint": lambda c: c.cast("long"), "double": lambda c: F.round(c, 6), "float": lambda c: F.round(c.cast("double"), 6)}
    return df.select(*(cast[t](F.col(f"`{c}`")).alias(c) if t in cast else F.col(f"`{c}`") for c, t in df.dtypes))


class Tables:
    """The supplied tables and adapters of one folder, read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return frame(self.spark, self.sf_dir, name)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None, uses: tuple[str, ...] = ()):
    """Register a function of Tables under `name`; `sql` follows the WITH clause of the adapters it uses."""

    def add(f: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(f(Tables(spark, sf_dir)))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            glue = ", " if sql.lstrip().startswith("+") else " "
            ORACLES[name] = f"{cte(*uses)}{glue}{sql.lstrip().removeprefix('+').strip()}" if uses else sql.strip()
        return f

    return add
