"""S: files written from the ledger and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from txlab.queries.oracle import on_tx
from txlab.queries.registry import query
from txlab.schemas import FRAUD_DESCRIPTIONS
from txlab.sources import files
from txlab.sources.ledger import ledger
from txlab.sources.staging import new_path

_ROWS = ("tx_id", "customer_id", "tx_date", "category", "description", "amount")
_ROWS_SCHEMA = (
    "tx_id string, customer_id bigint, tx_date date, category string, "
    "description string, amount double"
)

#: Texts with line ends, blanks, quotes and separators, empty and missing ones.
_AWKWARD = """CASE customer_id % 6 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN '  ' || description || ' '
    WHEN 3 THEN description || chr(10) || '"b",' WHEN 4 THEN chr(13) || chr(10) || description
    ELSE '\\' || description || chr(9) END"""


def _awkward():
    text, kind = F.col("description"), F.col("customer_id") % 6
    return (
        F.when(kind == 0, "")
        .when(kind == 1, None)
        .when(kind == 2, F.concat(F.lit("  "), text, F.lit(" ")))
        .when(kind == 3, F.concat(text, F.lit('\n"b",')))
        .when(kind == 4, F.concat(F.lit("\r\n"), text))
        .otherwise(F.concat(F.lit("\\"), text, F.lit("\t")))
    )


@query("s1_read_headered", on_tx(f"SELECT {', '.join(_ROWS)} FROM tx"))
def read_headered(spark, sf_dir):
    path = new_path(spark)
    files.write_table(ledger(spark, sf_dir, _ROWS), path, "csv")
    return files.read_table(spark, path, _ROWS_SCHEMA)


@query(
    "s2_read_headerless",
    on_tx(
        """SELECT fraud_type, concat(description, '"') AS "Description", category AS "Category"
        FROM tx"""
    ),
)
def read_headerless(spark, sf_dir):
    path = new_path(spark)
    rows = ledger(spark, sf_dir, ("fraud_type", "description", "category"))
    rows = rows.withColumn("description", F.concat("description", F.lit('"')))
    files.write_table(rows, path, "csv", header=False)
    return files.read_table(spark, path, FRAUD_DESCRIPTIONS, header=False)


@query("s3_drop_index", on_tx(f"SELECT {', '.join(_ROWS)} FROM tx"))
def drop_index(spark, sf_dir):
    path = new_path(spark)
    rows = ledger(spark, sf_dir, ("case_id", *_ROWS)).withColumnRenamed("case_id", "Unnamed: 0")
    files.write_table(rows, path, "csv")
    schema = f"`Unnamed: 0` bigint, {_ROWS_SCHEMA}"
    return files.drop_index_column(files.read_table(spark, path, schema))


@query("s4_null_tokens", on_tx("SELECT tx_id, bank_to FROM tx"))
def null_tokens(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "bank_to"))
    return files.null_tokens(rows.fillna("nan", ["bank_to"]), "bank_to")


@query("s5_roundtrip", on_tx(f"SELECT {', '.join(_ROWS)} FROM tx"))
def roundtrip(spark, sf_dir):
    path = new_path(spark)
    files.write_table(ledger(spark, sf_dir, _ROWS), path, partition_by=["category"])
    return files.read_table(spark, path, _ROWS_SCHEMA, fmt="parquet").select(*_ROWS)


@query(
    "s6_unwrap_csv",
    on_tx(
        """SELECT tx_id, concat(description, ', "', category, '"') AS description, amount, category
        FROM tx"""
    ),
)
def unwrap_csv(spark, sf_dir):
    path = new_path(spark)
    rows = ledger(spark, sf_dir, ("tx_id", "description", "amount", "category"))
    text = F.concat("description", F.lit(', "'), "category", F.lit('"'))
    record = F.to_csv(F.struct(text.alias("d"), "amount", "category"), {"escape": '"'})
    files.write_table(rows.select("tx_id", record.alias("line")), path, "csv")
    wrapped = files.read_table(spark, path, "tx_id string, line string")
    return files.unwrap_csv_column(
        wrapped, "line", "description string, amount double, category string"
    )


@query("s1_awkward_texts", on_tx(f"SELECT tx_id, {_AWKWARD} AS note, amount FROM tx"))
def read_awkward_texts(spark, sf_dir):
    path = new_path(spark)
    rows = ledger(spark, sf_dir, ("tx_id", "customer_id", "description", "amount"))
    files.write_table(rows.select("tx_id", _awkward().alias("note"), "amount"), path, "csv")
    return files.read_table(spark, path, "tx_id string, note string, amount double")


@query("s2_awkward_texts", on_tx(f"SELECT {_AWKWARD} AS note, tx_id FROM tx"))
def read_headerless_awkward_texts(spark, sf_dir):
    path = new_path(spark)
    rows = ledger(spark, sf_dir, ("tx_id", "customer_id", "description"))
    files.write_table(rows.select(_awkward().alias("note"), "tx_id"), path, "csv", header=False)
    return files.read_table(spark, path, "note string, tx_id string", header=False, line_end="\n")


@query("s5_roundtrip_csv", on_tx(f"SELECT tx_id, {_AWKWARD} AS note, tx_date, amount, category FROM tx"))
def roundtrip_csv(spark, sf_dir):
    path = new_path(spark)
    rows = ledger(spark, sf_dir, ("tx_id", "customer_id", "description", "tx_date", "amount", "category"))
    rows = rows.select("tx_id", _awkward().alias("note"), "tx_date", "amount", "category")
    files.write_table(rows, path, "csv", partition_by=["category"])
    return files.read_table(spark, path, "tx_id string, note string, tx_date date, amount double, category string")


@query("s6_awkward_records", on_tx(f"SELECT tx_id, {_AWKWARD} AS note, amount FROM tx"))
def unwrap_awkward_records(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "customer_id", "description", "amount"))
    record = F.to_csv(F.struct(_awkward().alias("note"), "amount"), files.RECORD)
    wrapped = rows.select("tx_id", record.alias("line"))
    return files.unwrap_csv_column(wrapped, "line", "note string, amount double")
