"""O1.9-O1.11, O6.47, O6.52: printed tables as grids, and what is read from them."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.operators.windows import Keys, over

_TABLE = re.compile(r"<table\b[^>]*>(.*?)</table\s*>", re.I | re.S)
_ROW = re.compile(r"<tr\b[^>]*>(.*?)(?=<tr\b|</table|\Z)", re.I | re.S)
_CELL = re.compile(r"<t[dh]\b([^>]*)>(.*?)(?=<t[dh]\b|</tr|<tr\b|\Z)", re.I | re.S)
_SPAN = {k: re.compile(rf"\b{k}\s*=\s*[\"']?(\d+)", re.I) for k in ("rowspan", "colspan")}
#: Fixed values of the HTML standard: larger spans count as these.
SPAN_MOST = {"rowspan": 65_534, "colspan": 1000}


def _text(html: str) -> str:
    return " ".join(unescape(re.sub(r"<[^>]*>", " ", html)).split())


def expanded(rows: list[list[tuple[str, int, int]]]) -> list[list[str]]:
    """O1.11: (text, rowspan, colspan) cells copied into every place they cover; rows padded to one width."""
    filled: dict[tuple[int, int], str] = {}
    for y, row in enumerate(rows):
        x = 0
        for text, down, across in row:
            while (y, x) in filled:
                x += 1
            for dy in range(min(down, len(rows) - y)):
                for dx in range(across):
                    filled.setdefault((y + dy, x + dx), text)
            x += across
    width = max((x for _, x in filled), default=-1) + 1
    return [[filled.get((y, x), "") for x in range(width)] for y in range(len(rows))]


def tables_of(html: str | None) -> list[list[list[str]]]:
    """All tables of a page as grids of text; a row without an end tag ends at the next."""
    found = []
    for table in _TABLE.finditer(html or ""):
        rows = []
        for row in _ROW.finditer(table[1]):
            cells = []
            for attributes, inner in _CELL.findall(row[1]):
                span = {k: min(SPAN_MOST[k], max(1, int(m[1]))) if (m := p.search(attributes)) else 1 for k, p in _SPAN.items()}
                cells.append((_text(inner), span["rowspan"], span["colspan"]))
            rows.append(cells)
        found.append(expanded(rows))
    return found


GRIDS = T.ArrayType(T.ArrayType(T.ArrayType(T.StringType())))


@F.pandas_udf(GRIDS)
def _grids(html: pd.Series) -> pd.Series:
    return pd.Series([tables_of(h) for h in html])


def grids(df: DataFrame, html: str, keys: Keys) -> DataFrame:
    """A row per table: ``keys``, table_ord, grid (array<array<string>>)."""
    return df.select(*keys, F.posexplode(_grids(F.col(html))).alias("table_ord", "grid"))


def grid_rows(df: DataFrame, keys: Keys, grid: str = "grid") -> DataFrame:
    """A row per grid row below the header: ``keys``, row_ord, label (first cell) and cells: array of (header, text)."""
    head = F.get(F.col(grid), F.lit(0))
    body = df.select(*keys, head.alias("__head"), F.posexplode(F.slice(F.col(grid), F.lit(2), F.greatest(F.size(grid) - 1, F.lit(0)))).alias("row_ord", "__row"))
    return body.select(*keys, "row_ord", F.get("__row", F.lit(0)).alias("label"), F.arrays_zip(F.col("__head").alias("header"), F.col("__row").alias("text")).alias("cells"))


def grid_cells(df: DataFrame, keys: Keys, wanted: str, skip: str = r"(?i)^(?:total|sum|합계|소계|계)$") -> DataFrame:
    """O6.47, O6.52: (keys, row_ord, label, header, text) of the columns whose header matches; total rows are left out."""
    rows = grid_rows(df, keys).where(~F.col("label").rlike(skip))
    return rows.select(*keys, "row_ord", "label", F.inline("cells")).where(F.col("header").rlike(wanted))


def _walker(label: str, indent: str):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[float, str]] = []  # indent and path, own label included, of the last row and its ancestors
        for batch in batches:
            *columns, first = batch.columns
            paths, depths = [], []
            names, spaces = (columns[batch.schema.get_field_index(c)].to_pylist() for c in (label, indent))
            for name, space, new in zip(names, spaces, first.to_pylist(), strict=True):
                if new:
                    stack.clear()
                space = math.nan if space is None else space
                while stack and stack[-1][0] >= space:
                    stack.pop()
                path = stack[-1][1] if stack else ""
                paths.append(path)
                depths.append(len(stack))
                stack.append((space, f"{path}>{name or ''}" if stack else name or ""))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(paths, pa.string()), pa.array(depths, pa.int32())], names=[*batch.schema.names[:-1], "path", "depth"])

    return walk


def with_paths(lines: DataFrame, keys: Keys, order: str, label: str, indent: str) -> DataFrame:
    """O1.9: ancestors by indent, joined with '>'; an ancestor is left when its indent is at least the row's own.

    Sequential within a table, whose rows are those of one page: a task sorts its tables and walks
    over all of them in one pass, with the stack carried from batch to batch. A null label counts as
    empty; a row with a null indent leaves no ancestor and is left by no row; a null order comes last.
    """
    schema = T.StructType([*lines.schema.fields, T.StructField("path", T.StringType()), T.StructField("depth", T.IntegerType())])
    first = F.row_number().over(over(keys, F.col(order).asc_nulls_last())) == 1
    return lines.withColumn("__first", first).mapInArrow(_walker(label, indent), schema)


def node_role(keys: Keys, order: str, indent: str) -> Column:
    """O1.10: P if the next row is deeper, S if it is shallower or there is none, F if equal."""
    after = F.lead(indent).over(over(keys, order))
    return F.when(after > F.col(indent), "P").when(after.isNull() | (after < F.col(indent)), "S").otherwise("F")
