"""Connections to document stores."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
#: Parts of messages that tell of a failed service lookup.
LOOKUP_MARKS = ("querysrv", "srv", "dns")


def is_lookup_error(error: Exception) -> bool:
    message = str(error).lower()
    return any(m in message for m in LOOKUP_MARKS)


def with_fallback(connect: Callable[[str], T], uri: str, direct: str | None = None) -> T:
    """``connect(uri)``; where the service lookup of ``uri`` fails, ``connect(direct)``, if there is a direct address."""
    try:
        return connect(uri)
    except Exception as error:
        if not direct or not is_lookup_error(error):
            raise
        return connect(direct)


def read_documents(spark: SparkSession, uri: str, direct: str | None = None, source: str = "mongodb", **options: str) -> DataFrame:
    """A collection through the store's Spark connector, which the session has to bring."""
    return with_fallback(lambda at: spark.read.format(source).option("connection.uri", at).options(**options).load(), uri, direct)


def append_documents(df: DataFrame, uri: str, direct: str | None = None, source: str = "mongodb", **options: str) -> None:
    """Append documents, such as :func:`lectern.operators.load.new_documents` finds, through the store's Spark connector."""
    with_fallback(lambda at: df.write.format(source).option("connection.uri", at).options(**options).mode("append").save(), uri, direct)
