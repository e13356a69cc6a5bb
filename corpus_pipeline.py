"""Raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and
read again as the documents of the next one, so that a stage starts from whole, stored input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quayside.llm.base import prepared, stored, table
from quayside.llm.line_windows import deduplicated_documents
from quayside.llm.mixing import mixed_documents
from quayside.llm.packing import packed_documents
from quayside.llm.quality_rules import kept_documents
from quayside.llm.signature_trees import distinct_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _prepared(stage: Stage) -> Stage:
    """The stage with the session's settings made first, as stages may be called one by one."""
    return lambda spark, docs, sf_dir: stage(prepared(spark), docs, sf_dir)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", _prepared(kept_documents)),
    ("line_windows", _prepared(deduplicated_documents)),
    ("signature_trees", _prepared(distinct_documents)),
    ("mixing", _prepared(mixed_documents)),
    ("packing", _prepared(packed_documents)),
]
# The last stage tokenizes, which SQL does not.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
