"""Text already extracted from documents, as one row per line."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import clean


def line_table(texts: DataFrame, text="text") -> DataFrame:
    """Every non-blank line with its position; the other columns are carried along."""
    others = [c for c in texts.columns if c != text]
    exploded = texts.select(*others, F.posexplode(F.split(text, "\n")).alias("line_number", "raw_line"))
    return exploded.select(
        *others, (F.col("line_number") + 1).alias("line_number"), clean("raw_line").alias("raw_line")
    ).filter("raw_line <> ''")
