"""Rows against a file index: first of each, unique matches, what is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REASONS = ("no_match", "ambiguous", "duplicate_path")


def first_of_each(df: DataFrame, keys: list[Column], order: str) -> DataFrame:
    """The first row of each key; limited per task before the shuffle, so hot keys cost little."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where("__n = 1").drop("__n")


def path_lookup(index: DataFrame, path: str = "relpath", size: str = "size") -> DataFrame:
    """language (lower case), genre, filename, size of paths <language>/<genre>/../<file> with n paths and one of them; shorter paths don't count."""
    parts = F.split(path, "/")
    rows = index.where(F.size(parts) >= 4).select(F.lower(parts[0]).alias("k_language"), parts[1].alias("k_genre"), F.element_at(parts, -1).alias("k_filename"), F.col(size).alias("k_size"), F.col(path).alias("path"))
    return rows.groupBy("k_language", "k_genre", "k_filename", "k_size").agg(F.count("*").alias("n"), F.min("path").alias("path"))


def resolve(df: DataFrame, lookup: DataFrame, on: Column, order: str) -> DataFrame:
    """df with path and status: resolved, no_match, ambiguous, or duplicate_path where an earlier row has the path."""
    joined = df.join(lookup, on, "left")
    one = F.col("n") == 1
    nth = F.row_number().over(Window.partitionBy(F.when(one, F.col("path")), F.when(~F.coalesce(one, F.lit(False)), F.col(order))).orderBy(order))
    status = F.when(F.col("n").isNull(), "no_match").when(F.col("n") > 1, "ambiguous").when(nth > 1, "duplicate_path").otherwise("resolved")
    return joined.withColumn("status", status).withColumn("path", F.when(F.col("status") == "resolved", F.col("path")))


def summary(resolved: DataFrame) -> DataFrame:
    """One row: how many of each reason, and resolved."""
    return resolved.agg(*(F.count_if(F.col("status") == r).alias(r) for r in (*REASONS, "resolved")))
