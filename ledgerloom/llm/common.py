"""Helpers shared by the corpus operators."""

import sys
import types

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def whole_texts(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, text) of every row; a null text is empty. Other columns, whatever their names, are left out."""
    return docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))


def documents(spark, folder) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def column(batch, name):
    """A column of an Arrow record batch as a Python list."""
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def worker_state() -> dict:
    """What a Python worker keeps from task to task, such as loaded tokenizers."""
    return sys.modules.setdefault("ledgerloom_worker", types.ModuleType("ledgerloom_worker")).__dict__
