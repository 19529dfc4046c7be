"""Catalogs: union of tabs, checks, typed load, metadata."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.checks import CheckError, require_columns, require_none
from sluice.functions.text import is_yes, stripped


def without_blank_columns(df: DataFrame) -> DataFrame:
    """Drops columns without a name, which CSV readers call _cN."""
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.strip() and not re.fullmatch(r"_c\d+", c)))


def tagged(df: DataFrame, language: str, tab: str) -> DataFrame:
    return without_blank_columns(df).withColumns({"language": F.lit(language), "source_tab": F.lit(tab)})


def union_tabs(tabs: list[DataFrame]) -> DataFrame:
    """All rows of all tabs with the first one's columns; cells that a tab lacks are empty, a column that the first lacks is an error."""
    first = tabs[0]
    for tab in tabs[1:]:
        extra = [c for c in tab.columns if c not in first.columns]
        if extra:
            raise CheckError(f"columns that the first tab lacks: {', '.join(extra)}")
        first = first.unionByName(tab.withColumns({c: F.lit("") for c in first.columns if c not in tab.columns}))
    return first


def contradictions(df: DataFrame, own: str, derived: Column) -> DataFrame:
    """own_language (trimmed, lower case), n: rows whose own language is given and isn't the derived one."""
    said = F.lower(stripped(F.col(own)))
    return df.withColumns({"own_language": said, "__derived": derived}).where((F.coalesce("own_language", F.lit("")) != "") & (F.col("own_language") != F.coalesce("__derived", F.lit("")))).groupBy("own_language").agg(F.count("*").alias("n"))


def refuse_contradictions(df: DataFrame, own: str, derived: Column) -> DataFrame:
    found = contradictions(df, own, derived).limit(20).collect()
    if found:
        raise CheckError(f"rows of another language than their tab: { {r.own_language: r.n for r in found} }")
    return df


def metadata(df: DataFrame, language: str, to_train: str) -> DataFrame:
    """One row for each language and one (null) for all: rows and rows to train on. Here yes isn't trimmed."""
    yes = F.count_if(F.lower(F.col(to_train)) == "yes")
    return df.rollup(language).agg(F.count("*").alias("total"), yes.alias("to_train"))


def load(df: DataFrame, row_index: Column, minutes: str = "duration_minutes", size: str = "size", source_id: str = "source_id", to_train: str = "to_train", defaults: dict[str, str] | None = None) -> DataFrame:
    """Rows to train on, typed: row_index counts all rows; minutes to seconds; absent columns get their defaults.

    Blank source ids among the kept rows are an error. Bad numbers raise when they are read.
    """
    require_columns(df, [minutes, size, source_id, to_train])
    kept = df.withColumn("row_index", row_index).where(is_yes(F.col(to_train)))
    require_none(kept, F.coalesce(stripped(F.col(source_id)), F.lit("")) == "", f"blank {source_id}")
    out = kept.withColumns({"duration_seconds": F.col(minutes).cast("double") * 60.0, "size_bytes": F.col(size).cast("long")})
    return out.withColumns({c: F.lit(v) for c, v in (defaults or {}).items() if c not in df.columns})
