"""Registration of queries together with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termweave.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, as_text: tuple[str, ...] = ()):
    """Register a query under its function's name.

    Dates come out as text, and so do the columns in ``as_text``: numbers and flags with
    NULLs, which the two engines hand over to pandas in different types.
    """

    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return dates_as_text(build(tune(spark), sf_dir), as_text)

        QUERIES[build.__name__] = run
        if oracle is not None:
            ORACLES[build.__name__] = oracle
        return build

    return register


def dates_as_text(df: DataFrame, others: tuple[str, ...] = ()) -> DataFrame:
    return df.select(
        [
            F.col(f"`{f.name}`").cast("string").alias(f.name)
            if isinstance(f.dataType, T.DateType) or f.name in others
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )
