"""Scalar text functions as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What an entry's name begins with, by family, in the order in which they are tried; and each family's main metric.
FAMILY_PREFIXES = {"asr": "asr", "sid": "sid", "er": "er_", "sd": "sd_", "asv": "asv"}
PRIMARY_METRIC = {"asr": "wer", "sid": "accuracy", "er": "accuracy", "asv": "eer"}


def stripped(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_yes(c: Column) -> Column:
    return F.lower(stripped(c)) == "yes"


def last_language(name: Column, languages: list[str]) -> Column:
    """The language that the name mentions last; null if none."""
    return F.try_element_at(F.regexp_extract_all(F.lower(name), F.lit("|".join(languages)), F.lit(0)), F.lit(-1))


def clip_id(path: Column) -> Column:
    """The file name without its last extension, and ten digits of the path's SHA-1: equal names in different folders differ."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.concat(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""), F.lit("-"), F.substring(F.sha1(path), 1, 10))


def md_cell(c: Column) -> Column:
    """Text for a Markdown table: white space runs to one space, pipes escaped."""
    return F.replace(stripped(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit("|"), F.lit("\\|"))


def family_of(name: Column, prefixes: dict[str, str] = FAMILY_PREFIXES) -> Column:
    """The first family whose prefix the name has; null if none."""
    return F.coalesce(*(F.when(F.startswith(name, F.lit(p)), F.lit(f)) for f, p in prefixes.items()))


def tag_pairs(value: Column) -> Column:
    """Structs k, v of comma-separated key=value items; blank items are left out, v is null where = or the key is missing."""
    items = F.filter(F.transform(F.split(value, ","), stripped), lambda x: x != "")

    def pair(x: Column) -> Column:
        at = F.instr(x, "=")
        return F.struct(stripped(F.substring_index(x, "=", 1)).alias("k"), F.when(at > 1, stripped(F.substr(x, at + 1))).alias("v"))

    return F.transform(items, pair)


def parse_tags(value: Column) -> Column:
    """A map of key=value items; of equal keys the last one wins. Bad items (see tag_pairs) are for a barrier to refuse."""
    pairs = F.filter(tag_pairs(value), lambda p: p["v"].isNotNull())
    last = F.filter(pairs, lambda p, i: F.size(F.filter(pairs, lambda q, j: (q["k"] == p["k"]) & (j > i))) == 0)
    return F.map_from_entries(last)


def step_of(name: Column, prefix: str = "checkpoint-") -> Column:
    """The number in a directory name that is just the prefix and digits; null for others."""
    digits = F.regexp_extract(name, rf"^{prefix}(\d+)$", 1)
    return F.when(digits != "", digits.cast("long"))
