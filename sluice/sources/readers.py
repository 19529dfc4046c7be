"""Readers: catalog CSVs, indexes, manifests, lists, results; file listings are in ``tree``."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.checks import CheckError, require_unique
from sluice.functions.text import last_language, step_of, stripped
from sluice.operators.catalog import refuse_contradictions, tagged, union_tabs
from sluice.operators.monitor import checkpoints, newest_first
from sluice.shared import located
from sluice.sources.tree import walk as listing
from sluice.sources.writers import UNFINISHED

__all__ = ["blocklist", "catalog", "checkpoint_listing", "csv", "index", "listing", "manifest", "manifest_cuts", "manifest_names", "newest_state", "results", "shards"]

INDEX_HEADER = "relpath\tsize"
MANIFEST = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "filename", "name_in_drive", "language", "genre", "speaking_style", "language_formality", "code_switching", "channel_id")] + [T.StructField("duration", T.DoubleType())])


def csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """All columns as text; quoted line ends and doubled quotes are kept together, empty cells are ''.

    Cells may have line ends, so a file is one task's; large catalogs come in many files, or, where no cell has line
    ends, with multi_line off, which splits files.
    """
    return spark.read.csv(path, header=True, multiLine=multi_line, quote='"', escape='"', inferSchema=False, ignoreLeadingWhiteSpace=False).na.fill("")


def catalog(spark: SparkSession, paths: list[str], languages: list[str]) -> DataFrame:
    """The union of CSV exports; a file's language is the one that its name mentions last."""
    tabs = []
    for path in paths:
        name = path.rstrip("/").rpartition("/")[2]
        language = spark.range(1).select(last_language(F.lit(name), languages)).first()[0]
        if language is None:
            raise CheckError(f"no language in the name {name}")
        tab = csv(spark, path)
        if "language" in tab.columns:
            refuse_contradictions(tab, "language", F.lit(language))
        tabs.append(tagged(tab, language, name))
    return union_tabs(tabs)


def index(spark: SparkSession, path: str) -> DataFrame:
    """relpath, size from a TSV whose first line is just that."""
    first = spark.read.text(path).first()
    if first is None or first[0] != INDEX_HEADER:
        raise CheckError(f"{path} doesn't begin with the header relpath, size")
    return spark.read.csv(path, sep="\t", quote="", header=True, schema="relpath string, size long")


def blocklist(spark: SparkSession, path: str | None, column: str = "channel_id") -> DataFrame:
    """The non-blank lines, trimmed, once each; none without a path."""
    if not path:
        return spark.createDataFrame([], f"{column} string")
    return spark.read.text(path).select(stripped(F.col("value")).alias(column)).where(f"{column} <> ''").distinct()


def manifest(spark: SparkSession, paths: list[str], schema: T.StructType = MANIFEST) -> DataFrame:
    return spark.read.schema(schema).json(paths)


def manifest_names(spark: SparkSession, paths: list[str], field: str = "filename") -> DataFrame:
    """One field's distinct values, in order."""
    return spark.read.schema(f"`{field}` string").json(paths).distinct().orderBy(field)


def manifest_cuts(rows: DataFrame, files: DataFrame, names: tuple[str, ...] = ("language", "genre", "channel_id")) -> DataFrame:
    """rows with a map custom of names, 'unknown' where absent; repeated ids and files that aren't there are errors."""
    require_unique(rows, "id")
    missing = rows.join(files.select("filename"), "filename", "left_anti")
    found = missing.agg(F.count("*").alias("n"), F.min("filename").alias("first")).first()
    if found.n:
        raise CheckError(f"{found.n} files are missing, the first is {found.first}")
    pairs = [x for n in names for x in (F.lit(n), F.coalesce(F.col(n), F.lit("unknown")))]
    return rows.withColumn("custom", F.create_map(*pairs))


def shards(spark: SparkSession, path: str, ids: list[int] | None = None, deal: DataFrame | None = None) -> DataFrame:
    """Written shards, all or some; only the wanted folders are read. deal: shard_id of the wanted ones, a row a shard, as ``cuts.dealt`` deals them to a worker; it prunes the folders while the query runs."""
    rows = spark.read.parquet(path)
    if deal is not None:
        rows = rows.join(F.broadcast(deal.select(F.col("shard_id").cast(rows.schema["shard_id"].dataType))), "shard_id")
    return rows if ids is None else rows.where(F.col("shard_id").isin(ids))


RESULT = "upstream string, results array<struct<upstream:string,task:string,language:string,name:string,kind:string,seed:long,status:string,split:string,metrics:map<string,double>,perf:struct<seconds_per_step:double,peak_gpu_gb:double>>>"


def results(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Nested benchmark results; the caller leaves out what isn't there and joins from its list of upstreams."""
    return spark.read.schema(RESULT).json(paths, multiLine=True)


def checkpoint_listing(spark: SparkSession, root: str) -> DataFrame:
    """folder and file of what is in folders that are named like checkpoints."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(F.split("path", "/").alias("p"))
    return rows.select(F.try_element_at("p", F.lit(-2)).alias("folder"), F.element_at("p", -1).alias("file")).where(step_of(F.col("folder")).isNotNull())


def newest_state(spark: SparkSession, root: str, needed: list[str], read: Callable[[str], Any], explicit: int | None = None) -> tuple[int, Any] | None:
    """The step and the state (what read makes of its folder) of the newest checkpoint that can be read; None without any.

    Only complete ones are tried, newest first; one that read raises for is passed over with a warning. An
    explicit one must be complete, and what read raises for it is raised. What stopped saves have left is removed first.
    """
    fs, at = located(spark, root)
    if not fs.exists(at):
        if explicit is not None:
            raise CheckError(f"checkpoint {explicit} is not complete")
        return None
    for status in fs.listStatus(at):
        if status.getPath().getName().startswith(UNFINISHED):
            fs.delete(status.getPath(), True)
    found = checkpoints(checkpoint_listing(spark, root), "folder", "file", needed)
    steps = [r.step for r in newest_first(found).collect()]  # a row a checkpoint
    if explicit is not None:
        if explicit not in steps:
            raise CheckError(f"checkpoint {explicit} is not complete")
        return explicit, read(f"{root}/checkpoint-{explicit}")
    for step in steps:
        try:
            return step, read(f"{root}/checkpoint-{step}")
        except Exception as e:  # noqa: BLE001 whatever is wrong with it, the one before may do
            warnings.warn(f"checkpoint {step} can't be read: {e}", stacklevel=2)
    return None
