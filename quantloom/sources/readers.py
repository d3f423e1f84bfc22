"""O1.1-O1.6: batch sources over landing zones. Collecting from the network happens elsewhere."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom import schemas
from quantloom.functions.text import label_key_of, with_amounts
from quantloom.operators.grids import tables_of
from quantloom.plans.market import clean_quotes

_KINDS = (("사업보고서|annual report", "FY"), ("반기보고서|half-year report|semiannual report", "H1"), ("분기보고서|quarterly report", "Q"))


def tables(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    """O1.1: Parquet tables of a folder by name."""
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}


def title_period(title: Column) -> tuple[Column, Column, Column]:
    """O1.2: (type, closing year, closing month) from a title such as '분기보고서 (2023.09)'."""
    kind = F.lit(None).cast("string")
    for pattern, name in reversed(_KINDS):
        kind = F.when(title.rlike(f"(?i){pattern}"), name).otherwise(kind)
    closing = r"\((\d{4})[.-](\d{2})\)"
    return kind, F.regexp_extract(title, closing, 1).try_cast("int"), F.regexp_extract(title, closing, 2).try_cast("int")


def disclosure_list(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """O1.2: filings from JSON lines (rcept, corp_code, title, filed_at), one a line; beside them the lines that are broken or have no rcept."""
    raw = spark.read.schema("rcept string, corp_code string, title string, filed_at string, _broken string").option("columnNameOfCorruptRecord", "_broken").json(path)
    kind, year, month = title_period(F.col("title"))
    bad = F.col("_broken").isNotNull() | F.col("rcept").isNull()
    good = raw.where(~bad).select("rcept", "corp_code", kind.alias("filing_type"), year.alias("close_year"), month.alias("close_month"), "title", F.col("filed_at").try_cast("timestamp_ntz").alias("filed_at"), F.lower("title").contains("정정").alias("is_amendment"))
    return good, raw.where(bad).select(F.coalesce("_broken", F.to_json(F.struct("corp_code", "title", "filed_at"))).alias("line"))


CELLS = "path string, table_ord int, row_ord int, col_ord int, label string, header string, text string"


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for path, content in zip(pdf["path"], pdf["content"], strict=True):
            for t, grid in enumerate(tables_of(bytes(content).decode("utf-8", "replace"))):
                head = grid[0] if grid else []
                rows += [(path, t, r, c, label_key_of(row[0]), head[c] if c < len(head) else "", row[c]) for r, row in enumerate(grid[1:], 1) for c in range(1, len(row))]
        yield pd.DataFrame(rows, columns=["path", "table_ord", "row_ord", "col_ord", "label", "header", "text"]).astype({"table_ord": "int32", "row_ord": "int32", "col_ord": "int32"})


def filing_documents(spark: SparkSession, path: str, glob: str = "*.{html,xml}", multiplier: int = 1) -> DataFrame:
    """O1.3: printed cells of HTML and XML filings, with amounts. A file is parsed by one task; files are split by size."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path", "content")
    return with_amounts(files.mapInPandas(_parse, CELLS), "text", F.lit(multiplier))


def quotes(spark: SparkSession, path: str) -> DataFrame:
    """O1.4, O1.6: daily quotes from CSV with a header, cleaned."""
    schema = "code string, day date, open long, high long, low long, close long, volume long"
    return clean_quotes(spark.read.schema(schema).option("header", "true").csv(path))


def exchange_daily(spark: SparkSession, path: str) -> DataFrame:
    """O1.5: raw close, listed shares and cap from CSV."""
    return spark.read.schema("code string, day date, raw long, listed long, market_cap long").option("header", "true").csv(path).where(F.col("raw") > 0)


def stored(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A stored table under its declared schema."""
    return spark.read.schema(getattr(schemas, kind)).parquet(path)
