"""Reading and writing table files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INDEX_COLUMNS = ("_c0", "Unnamed: 0")


#: What an unquoted empty field is read as before it becomes null; a private-use character, in no text.
_MISSING = "\uf8ff"
_BROKEN = "_broken_record"
#: The same text for reader and writer: doubled quotes, blanks kept, "" for an empty text, nothing for a null.
_DIALECT = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_READ = {**_DIALECT, "nullValue": _MISSING, "emptyValue": ""}
_WRITE = {**_DIALECT, "emptyValue": '""', "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _texts(options: dict) -> dict[str, str]:
    return {name: str(value).lower() if isinstance(value, bool) else value for name, value in options.items()}


#: Options of ``to_csv`` whose records ``unwrap_csv_column`` reads back.
RECORD = _texts(_WRITE)


def _broken(df: DataFrame) -> Column:
    """The text of a broken record. It takes reading all fields, as Spark checks only those that are asked for."""
    fields = [F.col(f"`{c}`") for c in df.columns if c != _BROKEN]
    return F.concat(_BROKEN, F.substring(F.xxhash64(*fields).cast("string"), 1, 0))


def _checked(df: DataFrame, broken: Column, bad: str | None, where: Column) -> DataFrame:
    """Broken records as a column, or as an error that shows the first one met."""
    if bad:
        return df.withColumn(bad, broken)
    message = F.concat(F.lit("a record doesn't fit the schema, in "), where, F.lit(": "), broken)
    return df.filter(F.when(broken.isNull(), True).otherwise(F.raise_error(message).cast("boolean")))


def _header_is_checked(spark: SparkSession, path: str, names: Sequence[str], options: dict) -> bool:
    """Whether every file's header must be the schema's names.

    A header that shares no name with the schema gives way to it; one that
    shares some must be the schema's. Blank names, as of unnamed row numbers,
    fit any column, but then only the first file's header is looked at.
    """
    found = spark.read.options(**options).option("header", True).csv(path).columns
    named = {k: c.lower() for k, c in enumerate(found) if c != f"_c{k}"}
    wanted = [n.lower() for n in names]
    if set(named.values()).isdisjoint(wanted):
        return False
    if len(named) < len(found) == len(wanted) and all(wanted[k] == c for k, c in named.items()):
        return False
    return True


def _read_csv(
    spark: SparkSession, path: str, schema: str, header: bool, bad: str | None, one_line: bool, line_end: str | None
) -> DataFrame:
    options = {**_READ, "multiLine": not one_line, **({"lineSep": line_end} if line_end else {})}
    names = spark.createDataFrame([], schema).columns
    checked = header and _header_is_checked(spark, path, names, options)
    read = (
        spark.read.schema(f"{schema}, `{_BROKEN}` string")
        .options(**options)
        .option("header", header)
        .option("enforceSchema", not checked)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BROKEN)
        .option("columnPruning", False)
        .csv(path)
    )
    return _checked(read, _broken(read), bad, F.input_file_name()).drop(_BROKEN)


def read_table(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    header: bool = True,
    fmt: str = "csv",
    bad: str | None = None,
    one_line: bool = False,
    line_end: str | None = None,
) -> DataFrame:
    """Read a CSV (doubled quotes, optional header and byte-order mark) or Parquet table.

    CSV needs a declared schema: inference would read the files twice and types
    would follow the data. An empty field is a missing value, a quoted empty one
    an empty text; blanks belong to the text, and quoted texts may hold line
    ends. A header in another order than the schema, or with only some of its
    names, is an error; one with none of them (or with blank ones) gives way to
    the schema. Every record is accounted for: one with too many or too few
    fields, or with a field that isn't of its type, is an error that shows it,
    or, with ``bad``, a row with its text in that column (null in good rows).

    A file is read by one task, as a line end may be inside a text: write many
    files, or state ``one_line`` where no text has any, and large files are
    split. ``line_end`` is found in each file unless stated. A quote that is
    never closed takes what follows into its text; only the number of fields
    shows that. Blank lines are no records.
    """
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV table needs a schema")
        return _read_csv(spark, path, schema, header, bad, one_line, line_end)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
    header: bool = True,
) -> None:
    """Write a table; ``read_table`` reads back the same rows.

    In CSV a text column that stands alone can't hold nulls, as its null is a
    blank line; that is an error.
    """
    writer = df
    if fmt == "csv":
        columns = [c for c in df.columns if c not in partition_by]
        if len(columns) == 1:
            value = F.col(f"`{columns[0]}`")
            lost = F.raise_error(F.lit("a null in the only column of a CSV table is a blank line")).cast(df.schema[columns[0]].dataType)
            writer = df.withColumn(columns[0], F.coalesce(value, lost))
        writer = writer.write.options(**_WRITE, lineSep="\n").option("header", header)
    else:
        writer = df.write
    writer = writer.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def drop_index_column(df: DataFrame, names: Sequence[str] = INDEX_COLUMNS) -> DataFrame:
    """Drop the unnamed row-number column that earlier exports carry."""
    return df.drop(*names)


def null_tokens(df: DataFrame, column: str, tokens: Sequence[str] = ("nan",)) -> DataFrame:
    """Turn texts that stand for a missing value into nulls."""
    value = F.col(column)
    return df.withColumn(column, F.when(~value.isin(*tokens), value))


def unwrap_csv_column(df: DataFrame, column: str, schema: str, bad: str | None = None) -> DataFrame:
    """Parse a text column whose values are CSV records into its fields, by the rules of ``read_table``.

    A record that doesn't fit the schema is an error that shows it, or, with
    ``bad``, a row with its text in that column. A null has no fields.
    """
    options = {**_READ, "multiLine": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    record = F.from_csv(F.col(column), f"{schema}, `{_BROKEN}` string", _texts(options))
    fields = df.withColumn("_record", record).drop(column).select("*", "_record.*").drop("_record")
    return _checked(fields, _broken(fields), bad, F.lit(column)).drop(_BROKEN)
