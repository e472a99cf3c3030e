import pytest
from pyspark.sql import functions as F

from txlab import schemas as S
from txlab.sources import files, staging
from txlab.sources.ledger import LEDGER_COLUMNS, ledger, table


def test_headerless_file_with_mark_and_doubled_quotes(spark, tmp_path):
    path = tmp_path / "descriptions.csv"
    path.write_bytes(
        '﻿Romance,Dinner for two,Dining out\r\nAdvanceFee,"Claim your prize ""now""",Shopping\r\n'.encode()
    )
    rows = files.read_table(spark, str(path), S.FRAUD_DESCRIPTIONS, header=False).collect()
    assert rows[0].fraud_type == "Romance"
    assert rows[1].Description == 'Claim your prize "now"'


def test_blank_index_header_is_dropped(spark, tmp_path):
    path = tmp_path / "indexed.csv"
    path.write_text(",0\n0,Water bill\n1,Car loan\n")
    df = files.drop_index_column(files.read_table(spark, str(path), "_c0 int, text string"))
    assert [r.text for r in df.collect()] == ["Water bill", "Car loan"]


def test_wrapped_records(spark, tmp_path):
    path = tmp_path / "wrapped.csv"
    path.write_text('﻿"Description,Amount,Category"\n"Market, corner,50.75,""Groceries"""\n"ATM,100.00,""Cash"""\n')
    lines = files.read_table(spark, str(path), "line string")
    rows = files.unwrap_csv_column(lines.filter(F.col("line").startswith("ATM")), "line", S.WRAPPED_TRANSACTION)
    assert [tuple(r) for r in rows.collect()] == [("ATM", 100.0, "Cash")]


def test_csv_needs_a_schema(spark, tmp_path):
    with pytest.raises(ValueError):
        files.read_table(spark, str(tmp_path))


def test_an_empty_text_and_a_missing_one_stay_apart(spark, tmp_path):
    path = str(tmp_path / "texts")
    df = spark.createDataFrame([("", 1), (None, 2), ("a,b", 3)], "t string, n int")
    files.write_table(df, path, "csv")
    got = {r.n: r.t for r in files.read_table(spark, path, "t string, n int").collect()}
    assert got == {1: "", 2: None, 3: "a,b"}


def test_null_tokens(spark):
    df = spark.createDataFrame([("nan",), ("bank_A",), (None,)], "b string")
    assert [r.b for r in files.null_tokens(df, "b").collect()] == [None, "bank_A", None]


def test_staging_uses_the_configured_folder(spark):
    staged = staging.stage(spark.range(10))
    assert staged.count() == 10
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    assert all(folder in name for name in staged.inputFiles())


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Session:
        class conf:
            get = staticmethod(lambda name, default=None: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="checkpoint.dir"):
        staging.staging_dir(Session)


def test_staged_buckets_are_read_without_a_shuffle(spark):
    df = staging.stage_in_buckets(spark.range(1000).withColumn("g", F.col("id") % 50), 4, "g")
    counts = df.groupBy("g").count()
    assert "Exchange" not in counts._jdf.queryExecution().toString() and counts.count() == 50
    name = [t.name for t in spark.catalog.listTables(pattern="txlab_staged_*")]
    assert name


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_foreign_keys_hold(spark, sf):
    """What leaving out unneeded joins of the ledger view rests on."""
    sf_dir = f"/root/testdata/sf{sf}"
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    pairs = (
        (lines, "l_orderkey", "orders", "o_orderkey"),
        (lines, "l_partkey", "part", "p_partkey"),
        (lines, "l_suppkey", "supplier", "s_suppkey"),
        (orders, "o_custkey", "customer", "c_custkey"),
    )
    for left, key, name, primary in pairs:
        right = table(spark, sf_dir, name)
        assert right.count() == right.select(primary).distinct().count()
        assert left.join(right, F.col(key) == F.col(primary), "left_anti").count() == 0


def test_ledger_schema_and_key(spark, sf_dir):
    df = ledger(spark, sf_dir)
    assert tuple(df.columns) == LEDGER_COLUMNS
    declared = spark.createDataFrame([], S.LEDGER).dtypes
    assert df.dtypes == declared
    assert df.select("tx_id").distinct().count() == df.count()


AWKWARD = ["a\nb", "", None, " q ", "x\r\ny", "\r", 'he said "hi"', '"', "\\", '\\"', "a,b", "#c", "\t", "NaN", '""', "\n", "end\\", "null", " "]
ROWS = "k int, t string, x double, d date, at timestamp, u string"


def awkward(spark):
    rows = [(k, t, k / 7, None if k % 5 == 0 else "2024-02-29", "2024-03-31 01:02:03.000456", AWKWARD[-k]) for k, t in enumerate(AWKWARD)]
    return spark.createDataFrame(rows, "k int, t string, x double, d string, at string, u string").selectExpr(
        "k", "t", "if(k = 3, double('Infinity'), if(k = 4, null, x)) AS x", "date(d) AS d", "timestamp(at) AS at", "u"
    )


@pytest.mark.parametrize("header", [True, False])
@pytest.mark.parametrize("line_end", [None, "\n"])
def test_texts_come_back_as_they_were(spark, tmp_path, header, line_end):
    path = str(tmp_path / "texts")
    df = awkward(spark).repartition(3)
    files.write_table(df, path, "csv", header=header)
    back = files.read_table(spark, path, ROWS, header=header, line_end=line_end)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert back.count() == len(AWKWARD) and back.select("u").filter("u IS NULL").count() == 1


def test_one_line_texts(spark, tmp_path):
    path = str(tmp_path / "texts")
    df = awkward(spark).filter("NOT coalesce(t RLIKE '[\\\\r\\\\n]', false) AND NOT coalesce(u RLIKE '[\\\\r\\\\n]', false)")
    files.write_table(df, path, "csv")
    back = files.read_table(spark, path, ROWS, one_line=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect())) and df.count() > 5


BROKEN = ["1,12.5 pounds", "2,3.5,4", "5", 'x,"a', '6,""']


def _file(folder, *lines):
    path = folder / "table.csv"
    path.write_bytes("".join(f"{line}\n" for line in lines).encode())
    return str(path)


@pytest.mark.parametrize("line", BROKEN)
def test_a_broken_record_is_shown(spark, tmp_path, line):
    df = files.read_table(spark, _file(tmp_path, "id,x", "7,8", line), "id int, x double")
    for read in (df.collect, df.count, df.select("id").collect):
        with pytest.raises(Exception, match="doesn't fit the schema") as error:
            read()
        assert line in str(error.value) and "table.csv" in str(error.value)


def test_broken_records_as_a_column(spark, tmp_path):
    df = files.read_table(spark, _file(tmp_path, "id,x", "7,8", *BROKEN[:3], "9,", BROKEN[4]), "id int, x double", bad="why")
    assert [tuple(r) for r in df.collect()] == [
        (7, 8.0, None), (1, None, BROKEN[0]), (2, 3.5, BROKEN[1]), (5, None, BROKEN[2]), (9, None, None), (6, None, BROKEN[4])
    ]
    assert df.count() == 6 and df.filter("why IS NOT NULL").count() == 4


@pytest.mark.parametrize("header", ["x,id", "id", "id,x,y", "id,y", "﻿x,id"])
def test_another_header_is_an_error(spark, tmp_path, header):
    with pytest.raises(Exception, match="(?i)header"):
        files.read_table(spark, _file(tmp_path, header, "1,2"), "id int, x double").collect()


@pytest.mark.parametrize("header", ["id,x", "﻿id,x", "ID,X", ",0", "a,b"])
def test_headers_that_fit_or_give_way(spark, tmp_path, header):
    df = files.read_table(spark, _file(tmp_path, header, "1,2.5"), "id int, x double")
    assert [tuple(r) for r in df.collect()] == [(1, 2.5)]


def test_the_header_of_every_file_is_checked(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x\n1,2\n")
    (tmp_path / "b.csv").write_text("x,id\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_table(spark, str(tmp_path), "id int, x double").collect()


def test_a_null_alone_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([("",), ("a",), (None,)], "t string")
    with pytest.raises(Exception, match="blank line"):
        files.write_table(df, str(tmp_path / "null"), "csv")
    files.write_table(df.filter("t IS NOT NULL"), str(tmp_path / "texts"), "csv")
    assert {r.t for r in files.read_table(spark, str(tmp_path / "texts"), "t string").collect()} == {"", "a"}


def test_records_in_a_column(spark):
    rows = [(1, '"a\nb",1.5,""'), (2, " q ,,\"x\r\ny\""), (3, None), (4, '"say ""hi""",-2,'), (5, '",",0,","')]
    df = spark.createDataFrame(rows, "k int, line string")
    fields = files.unwrap_csv_column(df, "line", "t string, x double, u string")
    assert [tuple(r) for r in fields.collect()] == [
        (1, "a\nb", 1.5, ""), (2, " q ", None, "x\r\ny"), (3, None, None, None), (4, 'say "hi"', -2.0, None), (5, ",", 0.0, ",")
    ]


@pytest.mark.parametrize("line", ["a", "a,b", "a,1.5,2", "a,1 pound"])
def test_broken_records_in_a_column(spark, line):
    df = spark.createDataFrame([(1, "b,2"), (2, line)], "k int, line string")
    with pytest.raises(Exception, match="doesn't fit the schema") as error:
        files.unwrap_csv_column(df, "line", "t string, x double").collect()
    assert line in str(error.value)
    marked = files.unwrap_csv_column(df, "line", "t string, x double", bad="why")
    assert [r.why for r in marked.collect()] == [None, line]
