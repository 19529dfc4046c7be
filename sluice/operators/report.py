"""Report texts, made on the driver from results of a few rows."""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, Row


def markdown(header: list[str], rows: Iterable[Iterable[object]], blank: str = "—") -> str:
    line = lambda cells: "| " + " | ".join(blank if c is None else str(c) for c in cells) + " |"
    return "\n".join([line(header), "|" + "---|" * len(header), *map(line, rows)]) + "\n"


def stats_json(stats: Row, cleaning: dict[str, int] | None = None, **maps: DataFrame) -> str:
    """A stats row with maps (name -> frame of a key and a number) beside it, keys in order, numbers rounded to 2 places, and what became of the catalog's rows."""
    out = stats.asDict() | ({"cleaning": cleaning} if cleaning else {})
    for name, frame in maps.items():
        out[name] = {str(r[0]): round(r[1], 2) for r in sorted(frame.collect(), key=lambda r: str(r[0]))}
    return json.dumps(out, indent=2, ensure_ascii=False)


def benchmark(rows: Iterable[Row], names: dict[str, str], families: list[str], seeds: object) -> tuple[str, str]:
    """The wide results (upstream, <family>_mean, <family>_std) as Markdown and as CSV; names has the upstreams in order and what to call them."""
    of = {r["upstream"]: r for r in rows}
    cell = lambda r, f: None if r is None or r[f"{f}_mean"] is None else f"{r[f'{f}_mean']:.3f} ± {r[f'{f}_std']:.3f}"
    text = f"# Benchmark Results\n\nTasks: {', '.join(families)}\n\nSeeds: {seeds}\n\n"
    text += markdown(["Upstream", *(f.upper() for f in families)], ([names[u], *(cell(of.get(u), f) for f in families)] for u in names))
    out = io.StringIO()
    lines = csv.writer(out, lineterminator="\n")
    lines.writerow(["upstream", *(f"{f.upper()}_{k}" for f in families for k in ("mean", "std"))])
    lines.writerows([names[u], *(of[u][f"{f}_{k}"] if u in of else None for f in families for k in ("mean", "std"))] for u in names)
    return text, out.getvalue()


def selection(stats: Row, target_hours: float, languages: Iterable[Row], genres: Iterable[Row], sources: Iterable[Row], overlap: int, cleaning: dict[str, int] | None = None) -> str:
    """The selection as Markdown tables: both sides, what became of the catalog's rows, train by language and genre, the longest sources.

    languages: rows of split.hours_by. genres: rows of split.top_by_hours, in their order. sources: rows of split.top_sources. cleaning:
    rows by what became of them, in the order in which they are told.
    """
    hours = lambda ms: f"{ms / 3_600_000:.2f}"
    part = lambda ms: f"{ms / stats.train_ms:.1%}" if stats.train_ms else None
    sides = [("train", hours(stats.train_ms), stats.train_segments, stats.train_channels), ("holdout", hours(stats.holdout_ms), stats.holdout_segments, stats.holdout_channels)]
    out = ["# Selected clips", markdown(["side", "hours", "clips", "channels"], sides)]
    out.append(f"Train was to have {target_hours:.2f} hours and falls short by {max(0.0, stats.shortfall_pct):.1f} %. Its longest clip takes {stats.longest_ms / 1000:g} s. Channels on both sides: {overlap}.\n")
    if cleaning:
        out += ["## Rows of the catalog", markdown(["rows", "number"], cleaning.items())]
    out += ["## Train by language", markdown(["language", "hours"], ((r[0], f"{r[1]:.2f}") for r in sorted(languages, key=lambda r: str(r[0]))))]
    out += ["## Train by genre", markdown(["genre", "hours", "share"], ((r[0], hours(r[1]), part(r[1])) for r in genres))]
    out += ["## Longest sources of train", markdown(["", "source", "hours", "share", "clips", "title"], ((r["rank"], r.channel_id, hours(r.total_ms), part(r.total_ms), r.n, cell(r.title)) for r in sources))]
    return "\n".join(out)


def cell(text: str | None) -> str:
    """A text on one line, with bars that don't end a cell."""
    return " ".join((text or "").split()).replace("|", "\\|")


def top_table(rows: Iterable[Row]) -> str:
    return markdown(["#", "source", "hours", "clips", "title"], ([r["rank"], r.channel_id, f"{r.total_ms / 3_600_000:.2f}", r.n, r.title] for r in rows))
