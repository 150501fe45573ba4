"""CSV whose quoted values hold line breaks, read in parallel.

A file is read as lines, in as many splits as any text file. A line break belongs to a
value if an odd number of quotes stands before it, so the parity of the quotes before each
line tells where records begin: a sum per split, an exclusive running sum over the
file's splits (one row each), and a running sum within each split. Lines of a record that
spans several, in one split or over more, are joined by the number of the record's
first line; all other lines, nearly all as a rule, are records as they stand. Each record is
then parsed by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import cut_lineage


def _quotes(line: Column, quote: str, escape: str) -> Column:
    """Quotes of a line that open or close a value (a doubled one does both)."""
    if escape and escape != quote:
        line = F.regexp_replace(line, "\\Q" + escape + "\\E.", "")
    return F.length(line) - F.length(F.replace(line, F.lit(quote), F.lit("")))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, line, value)``: the lines of all files; ``block`` is the first
    byte of the line's split, ``line`` its order within it."""
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value")


def csv_records(spark: SparkSession, path: str, quote: str = '"', escape: str = '"') -> DataFrame:
    """``(file, first, value)``: one row a record, ``first`` for each file's first
    one. Blank lines between records are left out, a carriage return before a record's line break goes."""
    lines = numbered_lines(spark, path).withColumn("quotes", _quotes(F.col("value"), quote, escape))
    split = Window.partitionBy("file").orderBy("block")
    earlier = split.rowsBetween(Window.unboundedPreceding, -1)
    parity = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    parity = parity.select("file", "block", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("earlier"))
    here = Window.partitionBy("file", "block").orderBy("line")
    before = F.coalesce(F.sum("quotes").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("earlier")
    marked = lines.join(parity, ["file", "block"]).withColumn("start", before % 2 == 0)
    number = F.sum(F.col("start").cast("long")).over(here.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = cut_lineage(marked.select("file", "block", "line", "value", "start", (F.col("quotes") % 2 == 1).alias("odd"), number.alias("number")))
    # lines before a split's first record go to the last record that began in an earlier one
    begun = marked.groupBy("file", "block").agg(F.max("number").alias("last"))
    last = F.last(F.when(F.col("last") > 0, F.struct("block", F.col("last").alias("number"))), ignorenulls=True).over(earlier)
    begun = begun.select("file", "block", last.alias("open"))
    own = F.struct("block", "number")
    several = marked.filter(~F.col("start") | F.col("odd")).join(begun, ["file", "block"])
    several = several.select("file", F.when(F.col("number") > 0, own).otherwise(F.col("open")).alias("record"), F.struct("block", "line", "value").alias("part"))
    several = several.groupBy("file", "record").agg(F.array_sort(F.collect_list("part")).alias("parts")).select(
        "file", "record", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"))
    records = marked.filter(F.col("start") & ~F.col("odd")).select("file", own.alias("record"), "value").unionByName(several)
    first = (F.col("record.block") == 0) & (F.col("record.number") == 1)
    return records.select("file", first.alias("first"), F.regexp_replace("value", "\r\\z", "").alias("value")).filter(F.trim("value") != "")


def read_csv_records(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",", header: bool = True,
                     quote: str = '"', escape: str = '"') -> DataFrame:
    """CSV with an explicit schema and line breaks in quoted values; a large file is
    many tasks. Quotes must be balanced within a record (an open quote runs to the end of its file)."""
    records = csv_records(spark, path, quote, escape)
    if header:
        records = records.filter(~F.col("first"))
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return records.select(F.from_csv("value", ddl, {"sep": sep, "quote": quote, "escape": escape}).alias("r")).select("r.*")
