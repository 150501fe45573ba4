"""Projection, filters and row shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_as(df: DataFrame, *exprs: str) -> DataFrame:
    """``selectExpr('a as b', ...)``."""
    return df.selectExpr(*exprs)


def drop_cols(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def with_derived(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add or replace several derived columns in one projection."""
    return df.withColumns(columns)


def with_literal(df: DataFrame, name: str, value) -> DataFrame:
    """Constant column, e.g. ``-1`` marking unlabelled rows."""
    return df.withColumn(name, F.lit(value))


def indicator(col: str | Column, value) -> Column:
    """0/1 flag for ``col == value`` (NULL stays NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    return (c == F.lit(value)).cast("int")


def polynomial(df: DataFrame, col: str, degree: int = 2, prefix: str | None = None) -> DataFrame:
    """Add ``x^2 .. x^degree`` next to ``x``."""
    p = prefix or col
    return df.withColumns({f"{p}_pow{k}": F.pow(F.col(col), F.lit(k)) for k in range(2, degree + 1)})


def parse_delimited(df: DataFrame, col: str, sep_regex: str,
                    fields: list[tuple[str, str]], strip_quotes: tuple[str, ...] = ()) -> DataFrame:
    """Split a delimited line into typed fields. Malformed numbers become NULL
    (``try_cast``); fields in ``strip_quotes`` lose their first and last char."""
    parts = F.split(F.col(col), sep_regex)
    out = []
    for i, (name, typ) in enumerate(fields):
        v = F.try_element_at(parts, F.lit(i + 1))
        if name in strip_quotes:
            v = F.substring(v, F.lit(2), F.length(v) - F.lit(2))
        out.append((v if typ == "string" else v.try_cast(typ)).alias(name))
    return df.select(*out)


def flat_map_split(df: DataFrame, col: str, pattern: str, name: str = "word",
                   keep: list[str] = ()) -> DataFrame:
    """``flatMap(lambda l: l.split(...))``: one row per non-empty piece."""
    return (df.select(*keep, F.explode(F.split(F.col(col), pattern)).alias(name))
              .filter(F.col(name) != ""))


def key_by(df: DataFrame, key: Column, name: str = "k", value: str = "v") -> DataFrame:
    """``keyBy(f)``: ``(f(row), row)`` with the row kept as a struct."""
    return df.select(key.alias(name), F.struct(*df.columns).alias(value))


def keys(df: DataFrame, key: str = "k") -> DataFrame:
    """``keys()``: one row per pair, the key alone."""
    return df.select(key)


def values(df: DataFrame, value: str = "v") -> DataFrame:
    """``values()``: one row per pair, the value alone."""
    return df.select(value)


def map_values(df: DataFrame, value: str, fn) -> DataFrame:
    """``mapValues``: one row per key, value transformed."""
    return df.withColumn(value, fn(F.col(value)))


def flat_map_values(df: DataFrame, value: str, fn, name: str | None = None) -> DataFrame:
    """``flatMapValues``: one row per element of ``fn(value)`` (an array)."""
    keep = [c for c in df.columns if c != value]
    return df.select(*keep, F.explode(fn(F.col(value))).alias(name or value))


def id_offset_union(train: DataFrame, test: DataFrame, id_col: str, test_id_col: str) -> DataFrame:
    """Give test rows ids after the largest train id and append them
    (columns aligned by name). The max is a scalar subquery, computed once;
    nothing goes through the driver."""
    max_id = train.agg(F.max(id_col)).scalar()
    shifted = (test.withColumn(id_col, (F.col(test_id_col) + max_id + F.lit(1)).cast("long"))
                   .drop(test_id_col))
    return train.unionByName(shifted)


def schema_table(df: DataFrame) -> DataFrame:
    """``columns`` / ``dtypes`` / ``printSchema`` as rows, each with the number
    of the table's values that are NULL (one aggregate over the table)."""
    rows = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"),
                     F.lit(f.nullable).alias("nullable"), F.col(f"_{i}").alias("n_null")) for i, f in enumerate(df.schema.fields)]
    counts = df.agg(*[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"_{i}") for i, c in enumerate(df.columns)])
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")

