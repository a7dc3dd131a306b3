"""Landing files: read as text, fingerprint, and cast to the contract."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctiers import settings as S
from acctiers.sources.records import records

SPARK_TYPES = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
}

# --- fixed values: boolean words ------------------------------------------------------------
TRUE_WORDS = ("true", "t", "yes", "1")
FALSE_WORDS = ("false", "f", "no", "0")


def contract_schema(source: str, contracts: Mapping | None = None) -> T.StructType:
    columns = (contracts or S.CONTRACTS)[source]
    return T.StructType([T.StructField(n, SPARK_TYPES[kind], nullable) for n, (kind, nullable) in columns.items()])


def text_schema(source: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in S.CONTRACTS[source]])


def tidy_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip().lower() for name in df.columns])


def empty_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def extract_csv(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True, file_column: str | None = None) -> DataFrame:
    """All columns as text, only the empty string is null; a record that does not fit the header is an error.

    Line breaks inside quotes are part of their field, and a large file is still read by many tasks (see
    ``records``).  ``multi_line=False`` saves the look at quotes for sources that hold no quoted line break; one
    that does then breaks its record, which is an error, too.  ``file_column`` names a column for the name of the
    file a record is from.
    """
    if file_column and not multi_line:
        raise ValueError("file_column needs multi_line")
    path = path if isinstance(path, str) else list(path)
    options = {"header": True, "inferSchema": False, "escape": '"', "multiLine": multi_line}
    names = spark.read.options(**options).csv(path).columns
    broken = "_broken_record"
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, broken]])
    if multi_line:
        read = {"escape": '"', "columnNameOfCorruptRecord": broken, "mode": "PERMISSIVE", "multiLine": "true"}
        rows = records(spark, path).where("not first and record <> ''")
        file = [F.url_decode(F.replace(F.element_at(F.split("file", "/"), -1), F.lit("+"), F.lit("%2B"))).alias(file_column)] if file_column else []
        raw = _parsed(rows, schema, read, file)
    else:
        raw = spark.read.schema(schema).options(**options, columnNameOfCorruptRecord=broken).csv(path)
    message = F.concat(F.lit("record does not fit the header: "), F.col(broken))
    checked = F.when(F.col(broken).isNotNull(), F.raise_error(message)).otherwise(F.nullif(F.col(f"`{names[0]}`"), F.lit("")))
    first = checked.alias(names[0].strip().lower())
    rest = [F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c.strip().lower()) for c in names[1:]]
    return raw.select(first, *rest, *([file_column] if file_column else []))


def _parsed(rows: DataFrame, schema: T.StructType, options: Mapping[str, str], more: Sequence[Column] = ()) -> DataFrame:
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)
    parsed = rows.select(F.from_csv("record", F.lit(ddl), dict(options)).alias("_record"), *more)
    return parsed.select("_record.*", *parsed.columns[1:])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """MD5 and length of the files whose lines come in order, one file after the other."""
    at, whole, size, left = None, None, 0, False

    def out():
        return pa.RecordBatch.from_pydict({"path": [at], "length": [size], "checksum": [whole.hexdigest()]})

    for batch in batches:
        for file, total, line in zip(*(batch[c].to_pylist() for c in ("file", "total", "line")), strict=True):
            if file != at:
                if at is not None:
                    yield out()
                at, whole, size = file, hashlib.md5(), 0
            whole.update(line)
            size += len(line)
            if size < total:  # the last line may have no line break
                whole.update(b"\n")
                size += 1
    if at is not None:
        yield out()


def file_checksums(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(path, length, checksum): MD5 of each file, of any size.

    MD5 needs the bytes in order, so the lines of a file are sorted by byte range into one task, which streams
    them; a task holds one line, not the file.  Empty files have no line and no row.
    """
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("total"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").cast("binary").alias("line"),
    )
    ordered = lines.repartition("file").sortWithinPartitions("file", "block", "row")
    return ordered.select("file", "total", "line").mapInArrow(_digest, "path string, length bigint, checksum string")


def content_digest(df: DataFrame) -> DataFrame:
    """Order-free digest of rows for data of any size: a partial aggregate, no sort."""
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor(row_hash).alias("digest"),
        F.sum(F.pmod(row_hash, F.lit(1_000_003))).alias("row_hash_sum"),
    )


def _checked(text: Column, value: Column, name: str, kind: str) -> Column:
    """``value``, failing the job when text is present and does not convert."""
    message = F.concat(F.lit(f"column {name}: cannot read as {kind}: "), text)
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(message)).otherwise(value)


def _conform_column(text: Column, name: str, kind: str) -> Column:
    if kind == "string":
        return text.cast("string")
    if kind == "boolean":
        word = F.lower(text.cast("string"))
        return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
    text = text.cast("string")
    if kind == "integer":
        # "1.0" is a whole number too
        number = text.try_cast("decimal(38,10)")
        whole = F.when(number == F.floor(number), number.cast("bigint"))
        return _checked(text, whole, name, kind)
    spark_type = {"float": "double", "date": "date", "timestamp": "timestamp_ntz"}[kind]
    return _checked(text, text.try_cast(spark_type), name, kind)


def conform(
    source: str, df: DataFrame, contracts: Mapping | None = None, keep: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    """Cast to the contract in one projection; also the names of the columns left out.  ``keep`` stays as it is."""
    contract = (contracts or S.CONTRACTS)[source]
    dropped = [c for c in df.columns if c not in contract and c not in keep]
    columns = [
        (_conform_column(F.col(n), n, kind) if n in df.columns else F.lit(None).cast(SPARK_TYPES[kind])).alias(n)
        for n, (kind, _) in contract.items()
    ]
    return df.select(*columns, *keep), dropped
