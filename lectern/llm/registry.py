"""Queries of the training-data operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.llm.avi import op9_avi
from lectern.llm.bpe import op6_bpe
from lectern.llm.itq import op10_itq
from lectern.llm.lm import op7_lm
from lectern.llm.packing import op5_packing
from lectern.llm.pii import op2_pii
from lectern.llm.resample import op1_quality
from lectern.llm.secrets import op8_secret_scan
from lectern.llm.simhash import op3_simhash
from lectern.llm.substrings import op4_substrings


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_pii, op3_simhash, op4_substrings, op5_packing, op6_bpe, op7_lm, op8_secret_scan, op9_avi, op10_itq)}


def oracle_sql() -> dict[str, str]:
    return {}
