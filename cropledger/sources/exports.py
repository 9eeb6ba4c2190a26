"""Wide CSV exports to long rows, all queries in one job, every line accounted for.

A file has a title line, a header line that starts with ``scenario``, and one column per year; the title and header may
come again further down, the header in another form too. A first scan counts lines and finds the headers, by file and split
of a file. Files with one header are read under it. In the others each line takes the last header above it: within its split by a
window, and at the top of a split from the splits before. No file passes through one task or one value.

A line is kept, or it is blank, a title or a header, or it is left out for a reason: a blank cell, too few or too
many cells, or no header above it. The classes are counted while the rows are written, and must add up to the lines of the
first scan. Cells that are not numbers are left out one by one. What is left out is reported by file.
"""

from __future__ import annotations

import csv
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from cropledger.operators.lookup import guard
from cropledger.operators.reshape import union_all
from cropledger.sources.catalog import literal_path, without_scheme
from cropledger.sources.literal import literal_table

# Fixed patterns: generated or trailing column names, the date cut off a scenario, year columns.
UNNAMED = re.compile(r"^X|\...")
SCENARIO_DATE = ",date.*$"
YEAR = re.compile(r"^\d{4}$")
HEADER_START = r'^"?scenario"?,'

#: Distinct headers a load may have, and headers that get a scan of their own; files of rarer ones are read like mixed files.
MOST_HEADERS, OWN_SCANS = 5_000, 64

#: What becomes of a line. Those of LEFT_OUT are reported.
KEPT, BLANK, HEADER, TITLE = "kept", "blank", "header", "title"
LEFT_OUT = ("blank cell", "too few cells", "too many cells", "no header above")
CLASSES = (KEPT, BLANK, HEADER, TITLE, *LEFT_OUT)


class LinesLost(RuntimeError):
    """The lines written and left out are not the lines read."""


@dataclass(frozen=True)
class QueryTable:
    """A long table, the cells that could not be read as numbers, the lines left out (path, text, reason), and
    (path, reason) of the files left out."""

    rows: DataFrame
    rejected_cells: DataFrame
    rejected_rows: DataFrame
    rejected_files: list[tuple[str, str]]


@dataclass(frozen=True)
class Header:
    """A header line and the columns of it that count."""

    text: str
    width: int
    kept: tuple[tuple[int, str], ...]

    @classmethod
    def parse(cls, text: str) -> Header:
        """Blank names become generated ones, which the cleaning drops."""
        fields = next(csv.reader([text]))
        names = [name.strip() or f"...{i}" for i, name in enumerate(fields, start=1)]
        return cls(text, len(names), tuple((i, n) for i, n in enumerate(names) if not UNNAMED.search(n)))

    @property
    def years(self) -> list[tuple[int, int]]:
        return [(int(n), i) for i, n in self.kept if YEAR.match(n)]

    @property
    def dims(self) -> dict[str, int]:
        return {n: i for i, n in self.kept if not YEAR.match(n)}

    @property
    def fault(self) -> str | None:
        repeated = [n for n, k in Counter(n.lower() for _, n in self.kept).items() if k > 1]
        return f"repeated column {repeated[0]}" if repeated else None


def decoded(path: Column) -> Column:
    """A file path as listings show it: percent escapes resolved, a plus sign left alone."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def lines_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path, split (where it starts in the file), at (grows within a split), line."""
    found = spark.read.text([literal_path(p) for p in paths])
    return found.select(
        decoded(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
    )


def _is_header(line: Column) -> Column:
    return line.rlike(HEADER_START)


def splits_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines, distinct headers and the last header of every split: what the driver and the second scan need to know."""
    lines = lines_of(spark, paths)
    header = F.when(_is_header(F.col("line")), F.col("line"))
    return lines.groupBy("path", "split").agg(
        F.count(F.lit(1)).alias("lines"), F.collect_set(header).alias("headers"),
        F.max_by(header, F.when(header.isNotNull(), F.col("at"))).alias("last"),
    )


def _below(paths: Sequence[str], splits: DataFrame, number: Column, spark: SparkSession) -> DataFrame:
    """Lines of files with several headers, each with the number of the last header above it."""
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = splits.select("path", "split", F.last(number(F.col("last")), ignorenulls=True).over(before).alias("carried"), F.lit(True).alias("known"))
    lines = lines_of(spark, paths).join(carried, ["path", "split"], "left")
    message = F.concat(F.lit("file changed, or was split in another way, while it was read: "), F.col("path"))
    lines = guard(lines, F.col("known").isNull(), message)
    above = Window.partitionBy("path", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    own = F.when(_is_header(F.col("line")), number(F.col("line")))
    return lines.select("path", "line", F.coalesce(F.last(own, ignorenulls=True).over(above), F.col("carried")).alias("h"))


def _classified(lines: DataFrame, headers: list[Header], names: list[str], spark: SparkSession) -> DataFrame:
    """Each line with its cells, its class, and its header's columns."""
    ints, texts = "array<int>", "array<string>"
    table = literal_table(
        spark,
        {"h": "int", "width": "int", "kept": ints, "columns": texts, "years": ints, "year_at": ints, "slots": ints},
        [
            (k, x.width, [i for i, _ in x.kept], [n for _, n in x.kept], [y for y, _ in x.years], [i for _, i in x.years],
             [x.dims.get(n) for n in names])
            for k, x in enumerate(headers)
        ],
    )
    widest = max([x.width for x in headers], default=1)
    cells = F.from_csv("line", ", ".join(f"c{i} string" for i in range(widest)), {"escape": "\""})

    def cell(i: int) -> Column:
        text = F.trim(F.col(f"cells.c{i}"))
        return F.when(~text.isin("", "NA"), text)

    parsed = lines.join(table, "h", "left").withColumn("cells", cells).withColumn("cells", F.array(*[cell(i) for i in range(widest)]))
    # Cells by commas outside quotes; a blank tail beyond the header is no harm.
    bare = F.regexp_replace("line", '"[^"]*"', "")

    def commas(text: Column) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(",")))

    parsed = parsed.withColumns({
        "found": commas(bare) + 1, "tail": commas(F.regexp_extract(bare, r"[,\s]*$", 0)),
        "own": F.transform("kept", lambda i: F.get("cells", i)),
    })
    none = F.lit(None).cast("string")
    only_first = F.forall(F.slice("own", 2, F.greatest(F.size("own") - 1, F.lit(0))), lambda x: x.isNull()) & (F.size("own") > 1)
    whole = F.forall("own", lambda x: x.isNotNull())
    single = F.col("found") - F.col("tail") <= 1
    kind = (
        F.when(F.trim("line") == "", BLANK)
        .when(_is_header(F.col("line")), HEADER)
        .when(F.col("width").isNull(), F.when(single, TITLE).otherwise("no header above"))
        .when(F.get("own", F.lit(0)) == "scenario", HEADER)
        .when(F.col("found") - F.col("tail") > F.col("width"), "too many cells")
        .when(only_first, TITLE)
        .when(whole, KEPT)
        .when(F.col("found") <= F.array_max("kept"), "too few cells")
        .otherwise("blank cell")
    )
    shown = F.to_json(F.map_from_arrays("columns", "own"), {"ignoreNullFields": "false"})
    as_cells = F.col("class").isin("blank cell", "too few cells")
    return parsed.withColumn("class", kind).withColumn("shown", F.when(as_cells, shown).when(F.col("class").isin(*LEFT_OUT), F.col("line")).otherwise(none))


@dataclass(frozen=True)
class Parsed:
    """Files on their way to rows: ``out`` has a row for each number (kind ``rows``), each cell that is none (``cells``) and
    each line left out (``lines``). ``check`` holds the counts taken while ``out`` was written against the first scan."""

    out: DataFrame
    names: dict[str, list[str]]
    rejected_files: list[tuple[str, str]]
    splits: DataFrame
    lines: int
    seen: Observation

    def check(self) -> dict[str, int]:
        found = self.seen.get
        if found["lines"] != self.lines or sum(found[c] for c in CLASSES) != self.lines:
            raise LinesLost(f"{self.lines} lines read, {found} accounted for")
        return {c: found[c] for c in CLASSES}


def stored_name(column: str) -> str:
    """Name of an export's column among those of all queries: with a mark for its capitals, as names may differ by case only."""
    capitals = sum(1 << k for k, c in enumerate(column) if c != c.lower())
    return f"{column}~{capitals:x}" if capitals or column in ("kind", "query", "load") else column


def place(path: Column) -> dict[str, Column]:
    """version, scen and query of an export path; a folder of part files lies one level deeper than a plain file."""
    folders = F.split(path, "/")
    up = F.when(F.element_at(folders, -2).endswith(".csv"), F.lit(-1)).otherwise(F.lit(0))
    return {
        "version": F.element_at(folders, up - 3), "scen": F.element_at(folders, up - 2),
        "query": F.regexp_replace(F.element_at(folders, up - 1), r"\.csv$", ""),
    }


def parse(spark: SparkSession, paths: Sequence[str], query_of: dict[str, str], keep: Callable[[str, DataFrame], DataFrame] | None = None) -> Parsed:
    """All files, of whatever queries, as one table. ``query_of`` names the query by path without scheme; ``keep`` writes a table."""
    splits = splits_of(spark, paths)
    splits = keep("splits", splits) if keep else splits
    found = splits.groupBy("path").agg(F.sum("lines").alias("lines"), F.array_distinct(F.flatten(F.collect_list("headers"))).alias("headers")).collect()
    seen = {without_scheme(r["path"]): sorted(r["headers"]) for r in found}
    texts = sorted({h for of in seen.values() for h in of})
    if len(texts) > MOST_HEADERS:
        raise ValueError(f"{len(texts)} distinct header lines, at most {MOST_HEADERS} are expected")
    headers = [Header.parse(t) for t in texts]
    number = {t: k for k, t in enumerate(texts)}

    alone: dict[str, list[str]] = defaultdict(list)
    mixed, rejected = [], []
    for path in paths:
        own = seen.get(without_scheme(path), [])
        faults = [f for f in (headers[number[t]].fault for t in own) if f]
        if not own or faults:
            rejected.append((path, faults[0] if faults else "no header line"))
        elif len(own) == 1:
            alone[own[0]].append(path)
        else:
            mixed.append(path)
    for text in sorted(alone, key=lambda t: (-len(alone[t]), t))[OWN_SCANS:]:
        mixed += alone.pop(text)
    left = {without_scheme(p) for p, _ in rejected}
    lines = sum(r["lines"] for r in found if without_scheme(r["path"]) not in left)

    branches = [lines_of(spark, files).select("path", "line", F.lit(number[text]).alias("h")) for text, files in sorted(alone.items())]
    if mixed:
        numbers = F.create_map(*[F.lit(x) for t in sorted({h for p in mixed for h in seen[without_scheme(p)]}) for x in (t, number[t])])
        branches.append(_below(sorted(mixed), splits, lambda text: numbers[text], spark))

    names: dict[str, list[str]] = {}
    for path in paths:
        if without_scheme(path) not in left:
            have = names.setdefault(query_of[without_scheme(path)], [])
            for text in seen[without_scheme(path)]:
                have += [n for n in headers[number[text]].dims if n not in have]
    every = sorted({n for have in names.values() for n in have})
    observed = Observation()
    if not branches:
        none = spark.range(0).select(F.lit("").alias("path"), F.lit("").alias("line"), F.lit(0).alias("h"))
        branches = [none]
    classified = _classified(union_all(branches), headers, every, spark)
    counted = classified.observe(
        observed, F.count(F.lit(1)).alias("lines"), *[F.count_if(F.col("class") == c).alias(c) for c in CLASSES]
    )

    def item(kind: Column, year: Column, value: Column, text: Column) -> Column:
        return F.struct(kind.alias("kind"), year.cast("int").alias("year"), value.cast("double").alias("value"), text.alias("text"))

    def in_year(y: Column) -> Column:
        text = F.get("cells", y["year_at"])
        value = text.try_cast("double")
        return item(F.when(value.isNull(), "cells").otherwise("rows"), y["years"], value, text)

    numbers = F.transform(F.arrays_zip("years", "year_at"), in_year)
    whole = F.array(item(F.lit("lines"), F.lit(None), F.lit(None), F.col("shown")))
    rows = counted.withColumn("item", F.explode(F.when(F.col("class") == KEPT, numbers).when(F.col("class").isin(*LEFT_OUT), whole)))
    is_row = F.col("item.kind") == "rows"

    def dim(k: int, name: str) -> Column:
        text = F.get("cells", F.get("slots", F.lit(k)))
        text = F.regexp_replace(text, SCENARIO_DATE, "") if name == "scenario" else text
        return F.when(is_row, text).alias(stored_name(name))

    out = rows.select(
        "item.kind", *[dim(k, n) for k, n in enumerate(every)], "item.year", "item.value",
        F.when(~is_row, F.col("item.text")).alias("__text"), F.when(~is_row, F.col("path")).alias("__path"),
        F.when(~is_row, F.col("class")).alias("__reason"),
        *[c.alias(n) for n, c in place(F.col("path")).items()],
    )
    return Parsed(out, names, rejected, splits, lines, observed)


def read_query(spark: SparkSession, paths: list[str]) -> QueryTable:
    """All files of one query as one long table with the source folder as ``ss``."""
    parsed = parse(spark, paths, dict.fromkeys(map(without_scheme, paths), ""))
    if not parsed.names:
        raise ValueError(f"no readable export among {len(paths)} files")
    dims = parsed.names[""]
    of = {kind: parsed.out.where(F.col("kind") == kind) for kind in ("rows", "cells", "lines")}
    named = [F.col(f"`{stored_name(n)}`").alias(n) for n in dims]
    rows = of["rows"].select(*named, "year", "value", F.col("scen").alias("ss"), "version", "scen")
    cells = of["cells"].select(F.col("__path").alias("path"), "year", F.col("__text").alias("text"))
    lines = of["lines"].select(F.col("__path").alias("path"), F.col("__text").alias("text"), F.col("__reason").alias("reason"))
    return QueryTable(rows, cells, lines, parsed.rejected_files)
