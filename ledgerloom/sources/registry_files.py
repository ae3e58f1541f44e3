"""Registry folders: manifest, multi-file reading, strict-header CSV."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions import rules, text
from ledgerloom.operators.ordered import keep_first, union_all
from ledgerloom.operators.registry import MASTER_DEDUP, infer_certification, standardise
from ledgerloom.sources.sinks import written


def list_files(spark: SparkSession, folder) -> DataFrame:
    """Path and size of every file below the folder; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    return found.withColumn("inner", F.regexp_replace("path", f"^.*?{_plain(folder)}/+", ""))


def _plain(folder):
    return "".join("\\" + ch if ch in ".+*?()[]{}^$|\\" else ch for ch in folder.split("://")[-1].rstrip("/"))


def manifest(spark: SparkSession, folder) -> DataFrame:
    """One row per expected certification and extra folder: counts, chosen files, reason.

    Primary CSV files come before primary Excel files, any usable CSV, any usable Excel.
    """
    files = list_files(spark, folder).withColumns({
        "actual_folder": F.split_part("inner", F.lit("/"), F.lit(1)), "name": F.lower(F.element_at(F.split("inner", "/"), -1)), "_path": F.lower("inner"),
    }).filter(F.contains("inner", F.lit("/")) & (F.col("actual_folder") != "master_registry"))
    files = files.withColumns({
        "is_csv": F.endswith("name", F.lit(".csv")), "is_excel": F.col("name").rlike("\\.xlsx?$"),
        "hidden": F.contains("_path", F.lit("debug")) | F.contains("_path", F.lit("master_registry")),
        "skipped": rules.contains_any("name", fixed.SKIP_FILE_KEYWORDS), "is_primary": rules.contains_any("name", fixed.PRIMARY_FILE_KEYWORDS),
    })
    supported = (F.col("is_csv") | F.col("is_excel")) & ~F.col("hidden")
    usable, primary = supported & ~F.col("skipped"), F.col("is_primary")
    kinds = [usable & F.col("is_csv") & primary, usable & F.col("is_excel") & primary, usable & F.col("is_csv"), usable & F.col("is_excel")]
    chosen = [F.array_sort(F.collect_list(F.when(k, F.col("path")))) for k in kinds]
    grouped = files.groupBy("actual_folder").agg(
        F.count_if(supported).alias("files_found"), F.count_if(kinds[0]).alias("primary_csv_files"), F.count_if(kinds[1]).alias("primary_excel_files"),
        *[c.alias(f"_c{i}") for i, c in enumerate(chosen)])
    has = [F.size(f"_c{i}") > 0 for i in range(4)]
    names = ["selected_primary_csv_files", "selected_primary_excel_files_no_csv_available", "fallback_selected_any_usable_csv_files", "fallback_selected_any_usable_excel_files"]
    reason, pick = F.when(has[0], names[0]), F.when(has[0], F.col("_c0"))
    for i in (1, 2, 3):
        reason, pick = reason.when(has[i], names[i]), pick.when(has[i], F.col(f"_c{i}"))
    reason = reason.when(F.col("files_found") > 0, "supported_files_found_but_all_skipped_or_non_primary").otherwise("folder_exists_but_no_supported_files")
    found = grouped.withColumns({"selection_reason": reason, "selected_files": F.coalesce(pick, F.array().cast("array<string>")), "_key": F.regexp_replace(F.lower("actual_folder"), "[^a-z0-9]+", "")})
    expected = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("expected_certification"), F.lit(f).alias("expected_folder"), F.lit(text.column_key(f)).alias("_key")) for f, c in fixed.EXPECTED_FOLDERS.items()])))
    joined = expected.join(found, "_key", "full_outer")
    status = F.when(F.col("actual_folder").isNull(), "missing").when(F.col("expected_folder").isNull(), "extra_discovered_folder").otherwise("available")
    return joined.select(
        "expected_certification", "expected_folder", "actual_folder", status.alias("folder_status"), "files_found", "primary_csv_files", "primary_excel_files",
        F.size(F.coalesce("selected_files", F.array().cast("array<string>"))).alias("files_selected"), F.coalesce("selection_reason", F.lit("missing_folder")).alias("selection_reason"),
        F.coalesce("selected_files", F.array().cast("array<string>")).alias("selected_files"), F.startswith(F.coalesce("selection_reason", F.lit("")), F.lit("fallback")).alias("fallback_used"))


def _numbered_rows(spark, paths, encoding, quoted_lines) -> DataFrame:
    """CSV rows as text with their file, and ``src_ordinal``: their place in it from 0.

    A file may be read in several splits. Rows of a split have successive ids, so a place is the rows of the
    file's splits before plus the distance to the split's first id; one row for each split is joined.
    """
    rows = spark.read.option("header", True).option("encoding", encoding).option("escape", '"').option("multiLine", quoted_lines).option("inferSchema", False).csv(paths)
    rows = rows.select("*", F.col("_metadata.file_path").alias("source_file"), F.lit("csv").alias("source_sheet"),
                       F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_id"))
    splits = rows.groupBy("source_file", "_split").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy("source_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("source_file", "_split", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return rows.join(splits, ["source_file", "_split"]).withColumn("src_ordinal", F.col("_id") + F.col("_shift")).drop("_split", "_id", "_shift")


def _standardised(rows: DataFrame) -> DataFrame:
    """Rows with the certification of their file to the master schema; places in files are kept."""
    certified = infer_certification(rows, ["src_ordinal"])
    return standardise(rows.drop("certification").join(certified, "source_file"), stamp="-")


def read_csv_registry(spark: SparkSession, folder, encoding="UTF-8", quoted_lines=False) -> DataFrame:
    """All CSV files below the folder to the master schema.

    Files of one folder share a header; every value is read as text. ``quoted_lines`` is for files with line
    breaks in quoted values, of which each is one unit of work.
    """
    return _standardised(_numbered_rows(spark, folder, encoding, quoted_lines))


def headers(spark: SparkSession, files, encoding="UTF-8"):
    """Header of each file; an unreadable file gets its error instead."""
    found, errors = {}, {}
    for path in files:
        try:
            found[path] = tuple(spark.read.option("header", True).option("encoding", encoding).csv(path).columns)
        except Exception as error:
            errors[path] = str(error).splitlines()[0]
    return found, errors


def read_selected(spark: SparkSession, files, encoding="UTF-8", quoted_lines=False):
    """(standardised rows, errors by file): files with one header are read together."""
    found, errors = headers(spark, files, encoding)
    groups = {}
    for path, header in found.items():
        groups.setdefault(header, []).append(path)
    frames = [_standardised(_numbered_rows(spark, paths, encoding, quoted_lines)) for paths in groups.values()]
    return (union_all(frames) if frames else None), errors


def inventory(rows: DataFrame, errors) -> DataFrame:
    """One row per source file: its certification, rows read and error, if it could not be read."""
    read = rows.groupBy("source_file").agg(F.min("certification").alias("certification"), F.count("*").alias("rows"), F.lit("").alias("error"))
    failed = rows.sparkSession.createDataFrame([(f, "", 0, e) for f, e in errors.items()], "source_file string, certification string, rows long, error string")
    return read.unionByName(failed)


def build_master(spark: SparkSession, folder, encoding="UTF-8", quoted_lines=False):
    """(master registry, inventory, manifest) of the registry folders below ``folder``.

    The manifest chooses each folder's files; their rows are read, standardised, united and deduplicated,
    the first row of a key staying.
    """
    listed = manifest(spark, folder)
    files = sorted({f for r in listed.select("selected_files").collect() for f in r.selected_files if f.lower().endswith(".csv")})
    rows, errors = read_selected(spark, files, encoding, quoted_lines)
    if rows is None:
        raise ValueError(f"no readable registry file below {folder}")
    rows = written(rows)
    master = keep_first(rows, MASTER_DEDUP, ["source_file", "src_ordinal"])
    return master, inventory(rows, errors), listed


def read_strict_csv(spark: SparkSession, path, required, constants=()) -> DataFrame:
    """CSV with the separator its header shows; required columns must exist, constants are added."""
    header = spark.read.text(path).limit(1).collect()[0][0].lstrip("﻿")
    separator = max([",", ";", "\t", "|"], key=header.count)
    rows = spark.read.option("header", True).option("sep", separator).option("inferSchema", False).csv(path)
    rows = rows.toDF(*[c.lstrip("﻿").strip() for c in rows.columns])
    missing = [c for c in required if c not in rows.columns]
    if missing:
        raise ValueError(f"missing columns {missing} in {path}")
    return rows.fillna("").withColumns({n: F.lit(v) for n, v in dict(constants).items()})
