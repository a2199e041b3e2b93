"""File sources and sinks. Every reader takes an explicit schema (no inference scan)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DataType, DecimalType, DoubleType, MapType, NullType, StringType, StructField,
                               StructType)

from tidemark.operators.clean import null_tokens, text_to_bool


def read_csv(spark: SparkSession, path: str, schema: StructType, null_tokens_: Sequence[str] = (),
             bool_cols: Sequence[str] = (), header: bool = True, quote: str = '"') -> DataFrame:
    """Header CSV with a fixed schema (CRLF handled by the reader).

    With ``null_tokens`` the file is read as text first, every token (and the
    empty string) becomes NULL, then columns are ``try_cast`` to the schema, so
    a stray token never fails the job. ``bool_cols`` hold TRUE/FALSE text.
    """
    if not null_tokens_ and not bool_cols:
        return (spark.read.schema(schema).option("header", header).option("quote", quote)
                .option("mode", "PERMISSIVE").csv(path))
    text = StructType([StructField(f.name, StringType()) for f in schema.fields])
    df = spark.read.schema(text).option("header", header).option("quote", quote).csv(path)
    if null_tokens_:
        df = null_tokens(df, null_tokens_)
    if bool_cols:
        df = text_to_bool(df, bool_cols)
    return df.select(*[F.col(f.name) if f.name in bool_cols else F.col(f.name).try_cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def read_json(spark: SparkSession, path: str, schema: StructType, mode: str = "PERMISSIVE",
              corrupt: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """Strict-schema JSON lines -> (good rows, bad rows); ``mode='FAILFAST'`` raises instead.

    Lines are read as text and parsed with ``from_json``, so the bad-row frame
    can be queried on its own (Spark refuses queries that touch only the
    corrupt-record column of a raw JSON scan).
    """
    text = spark.read.text(path)
    full = StructType(schema.fields + [StructField(corrupt, StringType())])
    parsed = text.select(F.from_json("value", full, {"mode": mode, "columnNameOfCorruptRecord": corrupt})
                         .alias("_j")).select("_j.*")
    good = parsed.filter(F.col(corrupt).isNull()).drop(corrupt)
    bad = parsed.filter(F.col(corrupt).isNotNull())
    return good, bad


def read_dated(spark: SparkSession, template: str, run_date: dt.date, schema: StructType,
               date_col: str = "date", out_col: str = "spend_date") -> DataFrame:
    """Read the file of day ``run_date - 1`` named by ``template`` (``{date}`` = yyyy-MM-dd).

    The run date is a parameter (never ``now()``), so reruns are reproducible.
    Missing file -> FileNotFoundError. The text date column becomes a DATE.
    """
    day = (run_date - dt.timedelta(days=1)).strftime("%Y-%m-%d")
    path = template.format(date=day)
    try:
        df = spark.read.schema(schema).json(path)
        df.schema  # noqa: B018  (resolve now so a missing path fails here)
        if not df.inputFiles():
            raise FileNotFoundError(path)
    except Exception as e:  # AnalysisException: PATH_NOT_FOUND
        if "PATH_NOT_FOUND" in str(e) or isinstance(e, FileNotFoundError):
            raise FileNotFoundError(f"no input for {day}: {path}") from e
        raise
    return df.withColumn(out_col, F.to_date(F.col(date_col), "yyyy-MM-dd")).drop(date_col)


_WHOLE = ["byte", "short", "integer", "long"]      # each fits into the next
_DIGITS = {"byte": 3, "short": 5, "integer": 10, "long": 19}


def join_types(a: DataType, b: DataType) -> DataType:
    """Smallest type that holds the values of both; text where only text does.

    Whole numbers widen; with a decimal they become a decimal that keeps all digits, with a float or double a double;
    a date beside a timestamp becomes the timestamp; arrays, maps and structs join by their parts. The order of the
    arguments does not matter, and joining is associative up to text, so neither does the order of the parts.
    """
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    x, y = a.typeName(), b.typeName()
    if x in _WHOLE and y in _WHOLE:
        return max(a, b, key=lambda t: _WHOLE.index(t.typeName()))
    if {x, y} <= {*_WHOLE, "decimal"}:
        whole, scale = 0, 0
        for t in (a, b):
            own = t.scale if isinstance(t, DecimalType) else 0
            whole, scale = max(whole, (t.precision if isinstance(t, DecimalType) else _DIGITS[t.typeName()]) - own), max(scale, own)
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else StringType()
    if {x, y} <= {*_WHOLE, "decimal", "float", "double"}:
        return DoubleType()
    if {x, y} == {"date", "timestamp"} or {x, y} == {"date", "timestamp_ntz"}:
        return b if x == "date" else a
    if x == y == "array":
        return ArrayType(join_types(a.elementType, b.elementType), a.containsNull or b.containsNull)
    if x == y == "map":
        return MapType(join_types(a.keyType, b.keyType), join_types(a.valueType, b.valueType), a.valueContainsNull or b.valueContainsNull)
    if x == y == "struct":
        return join_schemas([a, b])
    return StringType()


def join_schemas(schemas: Sequence[StructType]) -> StructType:
    """Fields of all schemas (names without regard to case, in order of first appearance), each with its joined type."""
    fields: dict[str, StructField] = {}
    for f in (f for s in schemas for f in s.fields):
        old = fields.get(f.name.lower())
        fields[f.name.lower()] = StructField(old.name if old else f.name, join_types(old.dataType, f.dataType) if old else f.dataType)
    return StructType(list(fields.values()))


def _recast(c: Column, have: DataType, want: DataType) -> Column:
    """A column as the joined type; structs by field name, arrays by element."""
    if have == want:
        return c
    if isinstance(want, StructType) and isinstance(have, StructType):
        own = {f.name.lower(): f for f in have.fields}
        parts = [(_recast(c[own[f.name.lower()].name], own[f.name.lower()].dataType, f.dataType) if f.name.lower() in own
                  else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(want, ArrayType) and isinstance(have, ArrayType):
        return F.transform(c, lambda x: _recast(x, have.elementType, want.elementType))
    if isinstance(want, StringType) and isinstance(have, (StructType, ArrayType, MapType)):
        return F.to_json(c)
    return c.cast(want)


def read_evolving(spark: SparkSession, paths: Sequence[str], target: StructType | None = None) -> DataFrame:
    """Read Parquet parts written with different schemas as one frame.

    Without ``target`` the schema is derived from the parts' footers (:func:`join_schemas`), so int, bigint and text
    generations of a column need no schema by hand. Each part is read with its own schema and cast (columns that it
    lacks become NULL), then all parts are unioned by name. Plain ``mergeSchema`` cannot do the widening or the
    int/string mix. Only footers are read for the schema.
    """
    parts = [spark.read.parquet(p) for p in paths]
    target = target or join_schemas([p.schema for p in parts])
    out = None
    for part in parts:
        whole = _recast(F.struct(*part.columns), part.schema, target)
        part = part.select(whole.alias("_row")).select("_row.*")
        out = part if out is None else out.unionByName(part)
    return out


def write_snappy(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_partitioned(df: DataFrame, path: str, parts: Sequence[str] = (), mode: str = "append") -> None:
    """Snappy Parquet partitioned and clustered on ``parts`` (plain Parquet without any).

    The REBALANCE hint deals rows by the partition columns and lets AQE merge
    small partitions and split large ones to its advisory size
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), so a partition value
    holding a third of the rows is written by many tasks. ``df`` runs once.
    """
    w = df.hint("rebalance", *parts).write.mode(mode).option("compression", "snappy")
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int = 8,
              properties: dict | None = None) -> DataFrame:
    """Relational table read, split into ``num_partitions`` range queries on
    ``partition_column`` so the scan is parallel instead of one connection.
    (Not exercised in tests: no database server may run here.)"""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()
