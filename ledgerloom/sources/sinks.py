"""Writers: bounded text columns, decision partitions, ordered files."""

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.text import truncate


def shared_folder(spark: SparkSession) -> str:
    """New folder that driver and executors all reach: under the checkpoint folder, else under the
    warehouse, which a session always has. It goes when the driver's JVM ends."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    root = named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    folder = f"{root}/ledgerloom-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def written(df: DataFrame) -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, safe against lost
    executors, and of a size Spark knows when it plans the joins on it."""
    path = f"{shared_folder(df.sparkSession)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def truncate_strings(df: DataFrame, limit=2800) -> DataFrame:
    """Clean every string column and cut it at the limit."""
    return df.select(
        *[truncate(n, limit).alias(n) if kind == "string" else F.col(n) for n, kind in df.dtypes]
    )


def write_by_decision(audit: DataFrame, path: str) -> None:
    """One Parquet table partitioned by decision; each decision list is then a partition filter."""
    audit.write.mode("overwrite").partitionBy("decision").parquet(path)


#: Canonical orders of the written tables: columns, with a minus where the largest come first.
ORDERS = {
    "master": ["certification", "evidence_level", "certified_entity_name_normalized_strict", "certified_product_normalized_strict"],
    "sources": ["company_name_normalized", "-source_score", "source_confidence"],
    "summary": ["-source_count", "-max_source_score", "company_name_normalized"],
}


def ordered_by(table: str) -> list:
    """Sort expressions of a table's canonical order."""
    return [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in ORDERS[table]]


def write_ordered(df: DataFrame, path: str, *order, partitions=None) -> None:
    """Globally ordered files: range shuffle, then a sort inside each file. Rows of equal keys lie in one file."""
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def order_report(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One row about a written table: its rows, rows out of order inside a file, and files whose range begins
    before an earlier file's ends. Only one row for each file is compared across files."""
    keys = [c.lstrip("-") for c in ORDERS[table]]
    upward = F.struct(*[-F.col(c[1:]) if c.startswith("-") else F.col(c) for c in ORDERS[table]])
    rows = spark.read.parquet(path).select(*keys, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")).select("file", "place", upward.alias("key"))
    inside = rows.withColumn("before", F.lag("key").over(Window.partitionBy("file").orderBy("place")))
    files = inside.groupBy("file").agg(F.count("*").alias("rows"), F.count_if(F.col("before") > F.col("key")).alias("breaks"), F.min("key").alias("low"), F.max("key").alias("high"))
    overlaps = files.withColumn("reached", F.max("high").over(Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)))
    return overlaps.agg(F.sum("rows").alias("rows"), F.sum("breaks").alias("breaks_in_files"), F.count_if(F.col("reached") > F.col("low")).alias("breaks_between_files"))
