"""Readers, writers and their plans."""

import os
import struct

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

from starmart import session as session_module
from starmart.contracts import CONTRACTS, FACT_IMMIGRATION
from starmart.quality import schema_drift
from starmart.sinks import create_table_sql, refresh_partitions, stage, write_table
from starmart.sources import (
    AIRPORT_SCHEMA, CITY_SCHEMA, IMMIGRATION_SCHEMA, LABEL_SECTIONS, TEMPERATURE_SCHEMA, apply_schema,
    label_rejects, land, local_table, parse_labels, read_csv, read_lines, read_sas, read_source,
    read_table, source_path,
)


def test_csv_without_schema_is_text_by_header_name(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text('b,a\n1,"x, y"\n,z\n')
    df = read_csv(spark, str(file))
    assert df.dtypes == [("b", "string"), ("a", "string")]
    assert sorted(map(tuple, df.collect()), key=str) == sorted([("1", "x, y"), (None, "z")], key=str)


def test_csv_with_schema_refuses_a_changed_header(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text("b,a\n1,2\n")
    schema = StructType([StructField("a", IntegerType()), StructField("b", IntegerType())])
    with pytest.raises(Exception, match="header|CSV"):
        read_csv(spark, str(file), schema=schema).collect()


def test_csv_files_with_unlike_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception, match="header|CSV"):
        read_csv(spark, str(tmp_path)).select("a").collect()


def test_csv_malformed_cells_are_kept_apart(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text("a;b\n1;2.5\nx;3.5\nNA;4.5\n")
    schema = StructType([StructField("a", IntegerType()), StructField("b", DoubleType())])
    df = read_csv(spark, str(file), sep=";", schema=schema, corrupt_column="bad")
    found = sorted((r.b, r.a, r.bad) for r in df.collect())
    assert found == [(2.5, 1, None), (3.5, None, "x;3.5"), (4.5, None, "NA;4.5")]


def test_csv_missing_words_are_an_option(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text("continent,n\nNA,1\nEU,2\n")
    kept = read_csv(spark, str(file))
    assert {r.continent for r in kept.collect()} == {"NA", "EU"}
    read = read_csv(spark, str(file), null_values=["NA", "?"])
    assert {r.continent for r in read.collect()} == {None, "EU"}


def test_known_schemas_type_a_text_frame(spark):
    text = spark.createDataFrame(
        [("1743-11-01", "3.2", "1.8", "Akron", "US", "1N", "2W"), ("x", "warm", None, "A", "B", "", "")],
        TEMPERATURE_SCHEMA.fieldNames(),
    )
    typed = apply_schema(text, TEMPERATURE_SCHEMA)
    assert typed.schema == TEMPERATURE_SCHEMA
    assert [r.AverageTemperature is None for r in typed.sort("dt").collect()] == [False, True]
    assert (len(TEMPERATURE_SCHEMA), len(CITY_SCHEMA), len(AIRPORT_SCHEMA)) == (7, 12, 12)


def test_local_tables(spark):
    codes = local_table(spark, {"101": "FREDONIA"}, "code string, label string")
    assert [tuple(r) for r in codes.collect()] == [("101", "FREDONIA")]
    frame = local_table(spark, pd.DataFrame({"a": [1, 2], "b": ["x", None]}))
    assert frame.count() == 2 and frame.columns == ["a", "b"]


def test_source_paths():
    assert source_path("", "airport") == "data/airport-codes_csv.csv"
    assert source_path("s3a://bucket/in/", "labels").startswith("s3a://bucket/in/data/")


# --- SAS -----------------------------------------------------------------------------------

def test_sas_reads_every_file_in_chunks(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"m{i}.sas7bdat").write_bytes(b"not decoded here")
    (tmp_path / "other.txt").write_text("x")

    def decode(path):
        month = float(path[-10])
        for part in range(2):
            yield pd.DataFrame({
                "CICID": [month * 10 + part, None], "i94port": ["ABC", ""], "i94mon": [month, month],
            })

    df = read_sas(spark, str(tmp_path / "*.sas7bdat"), IMMIGRATION_SCHEMA, decode=decode)
    assert df.schema == IMMIGRATION_SCHEMA
    found = df.select("cicid", "i94mon", "i94port", "airline").collect()
    assert len(found) == 12
    assert sorted(r.cicid for r in found if r.cicid is not None) == [0.0, 1.0, 10.0, 11.0, 20.0, 21.0]
    assert {r.i94port for r in found} == {"ABC", None} and {r.airline for r in found} == {None}


def ibm_double(value: float) -> bytes:
    """A number as SAS transport files hold it."""
    if value == 0:
        return bytes(8)
    sign, value, exponent = (0x80 if value < 0 else 0), abs(value), 64
    while value >= 1:
        value, exponent = value / 16, exponent + 1
    while value < 1 / 16:
        value, exponent = value * 16, exponent - 1
    return bytes([sign | exponent]) + int(value * 2**56).to_bytes(7, "big")


def transport_file(names: list[str], rows: list[list[float]]) -> bytes:
    """A minimal SAS transport file with numeric columns."""
    def header(kind, numbers="000000000000000000000000000000"):
        return f"HEADER RECORD*******{kind:<8}HEADER RECORD!!!!!!!{numbers}  ".encode()

    when = b"01JAN16:00:00:00"
    out = header("LIBRARY")
    out += b"SAS     SAS     SASLIB  9.4     LINUX   " + b" " * 24 + when + when + b" " * 64
    out += header("MEMBER", "000000000000000001600000000140") + header("DSCRPTR")
    out += b"SAS     ROWS    SASDATA 9.4     LINUX   " + b" " * 24 + when + when + b" " * 64
    out += header("NAMESTR", f"000000{len(names):04d}00000000000000000000")
    described = b""
    for i, name in enumerate(names):
        described += struct.pack(">hhhh8s40s8shhh2s8shhl52s", 1, 0, 8, i + 1, name.encode().ljust(8),
                                 b" " * 40, b" " * 8, 0, 0, 0, b"\0\0", b" " * 8, 0, 0, i * 8, b"\0" * 52)
    out += described + b" " * (-len(described) % 80) + header("OBS")
    data = b"".join(ibm_double(v) for row in rows for v in row)
    return out + data + b" " * (-len(data) % 80)


def test_sas_decodes_real_files(spark, tmp_path):
    for i in range(2):
        content = transport_file(["CICID", "ARRDATE"], [[100 * i + k, 20573 + k] for k in range(25)])
        (tmp_path / f"f{i}.xpt").write_bytes(content)
    schema = StructType([StructField("cicid", LongType()), StructField("arrdate", DoubleType()),
                         StructField("gender", StringType())])
    df = read_source(
        spark, str(tmp_path / "*.xpt"), "sas", schema=schema, file_format="xport", chunk_rows=10
    )
    found = sorted(map(tuple, df.collect()))
    assert found == sorted((100 * i + k, 20573.0 + k, None) for i in range(2) for k in range(25))
    with pytest.raises(ValueError):
        read_source(spark, "x", "xml")


def test_sas_scan_reads_no_contents(spark, tmp_path):
    (tmp_path / "a.sas7bdat").write_bytes(b"x")
    df = read_sas(spark, str(tmp_path), IMMIGRATION_SCHEMA, decode=lambda path: iter(()))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in plan


# --- lines and labels --------------------------------------------------------------------

def test_line_numbers_do_not_depend_on_splits(spark, tmp_path):
    for name, n in (("a", 700), ("b", 50), ("c", 0)):
        (tmp_path / name).write_text("".join(f"{name} {i}\r\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        found = read_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(found) == 750
    assert all(r.line.split()[1] == str(r.pos) for r in found)


def test_label_rejects(spark, tmp_path):
    file = tmp_path / "labels"
    lines = ["x = y"] * 9 + ["outside", "  1 = 'A'", "no pair here", "", " 1 = 'B'"]
    file.write_text("\n".join(lines))
    read = read_lines(spark, str(file))
    section = LABEL_SECTIONS["country_code"]
    assert sorted(r.pos for r in label_rejects(read, section).collect()) == [11, 12]
    assert [tuple(r) for r in parse_labels(read, section).collect()] == [("1", "B")]


# --- sinks -------------------------------------------------------------------------------

@pytest.fixture
def arrivals(spark):
    return spark.createDataFrame(
        [(i, "NY" if i % 3 == 0 else "CA" if i % 3 == 1 else None) for i in range(300)],
        "uid int, state_code string",
    )


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_partitioned_write_keeps_all_rows(spark, arrivals, tmp_path, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        path = str(tmp_path / "t")
        write_table(arrivals, path, ["state_code"])
        write_table(arrivals, path, ["state_code"])
        back = read_table(spark, path, schema=arrivals.schema)
        assert back.exceptAll(arrivals).count() == 0 and back.count() == 300
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_hot_partition_is_cut(spark, tmp_path):
    """Most rows of one state: the rebalance writes its directory with several tasks."""
    rows = spark.range(200_000).select(
        F.col("id").alias("uid"), F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 50 == 0, "NY").otherwise("CA").alias("state_code"),
    ).repartition(8)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        write_table(rows, str(tmp_path / "t"), ["state_code"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = [f for f in os.listdir(tmp_path / "t" / "state_code=CA") if f.endswith(".parquet")]
    assert len(files) > 4
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


def test_overwrite_drops_partitions_a_refresh_keeps_them(spark, arrivals, tmp_path):
    path = str(tmp_path / "t")
    ny = arrivals.filter("state_code = 'NY'").limit(5)
    write_table(arrivals, path, ["state_code"])
    refresh_partitions(ny, path, ["state_code"])
    back = read_table(spark, path, schema=arrivals.schema)
    assert back.filter("state_code = 'NY'").count() == 5 and back.count() == 205
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_table(ny, path, ["state_code"])
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    assert read_table(spark, path, schema=arrivals.schema).count() == 5


def test_reads_prune_partitions_and_columns(spark, arrivals, tmp_path):
    path = str(tmp_path / "t")
    write_table(arrivals.withColumn("other", F.lit("x")), path, ["state_code"])
    df = read_table(spark, path, ["uid", "state_code"]).filter("state_code = 'NY' and uid > 7")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(state_code" in plan
    assert "GreaterThan(uid,7)" in plan and "ReadSchema: struct<uid:int>" in plan


def test_declared_table(spark, tmp_path):
    statement = create_table_sql(FACT_IMMIGRATION, str(tmp_path), "declared_fact")
    spark.sql("drop table if exists declared_fact")
    spark.sql(statement)
    found = spark.table("declared_fact").schema
    assert {f.name: f.dataType for f in found} == {f.name: f.dataType for f in FACT_IMMIGRATION.schema}
    assert "PARTITIONED BY (state_code)" in statement
    for contract in CONTRACTS.values():
        assert f"EXISTS {contract.name} (" in create_table_sql(contract, "/x")
    spark.sql("drop table declared_fact")


def test_stage_and_land(spark):
    df = spark.range(10).withColumn("b c", F.lit("x"))
    assert stage(df, "t").count() == 10
    landed = land(df, ["b c"], "t")
    assert landed.columns == ["b c"] and landed.inputFiles()


def test_drift(spark):
    found = schema_drift(
        StructType([StructField("a", LongType()), StructField("c", StringType())]),
        StructType([StructField("a", IntegerType()), StructField("b", StringType())]),
        spark.range(1),
    )
    assert [tuple(r) for r in found.collect()] == [
        ("a", "int", "bigint", "retyped"), ("b", "string", None, "missing"), ("c", None, "string", "extra"),
    ]


def test_session_settings(spark, monkeypatch):
    conf = session_module.conf_for(100 * 2**40)
    # no task of more than 512 MB of input
    assert conf["spark.sql.shuffle.partitions"] == "204800"
    assert conf["spark.sql.files.maxPartitionBytes"] == str(2**29)
    small = session_module.conf_for(10 * 2**30)
    assert small["spark.sql.shuffle.partitions"] == "80"
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 * 2**20)
    assert session_module.conf_for(1)["spark.sql.shuffle.partitions"] == "8"
    assert session_module.new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert session_module.new_path(spark, "x") != session_module.new_path(spark, "x")


def test_compressed_csv_holds_the_same_rows_in_bounded_files(spark, tmp_path, monkeypatch):
    import os

    from starmart.session import stored_bytes
    from starmart.sinks import tables, write_csv

    monkeypatch.setattr(tables, "_PACKED_ROWS", 100)
    df = spark.range(1000).selectExpr("id", "concat('a,\"', id) as t").coalesce(1)
    write_csv(df, f"{tmp_path}/plain")
    write_csv(df, f"{tmp_path}/packed", compressed=True)
    files = [f for f in os.listdir(tmp_path / "packed") if f.startswith("part-")]
    assert len(files) == 10 and all(f.endswith(".csv.gz") for f in files)
    assert sorted(read_csv(spark, f"{tmp_path}/packed").collect()) == sorted(read_csv(spark, f"{tmp_path}/plain").collect())
    size = sum(os.path.getsize(tmp_path / "packed" / f) for f in os.listdir(tmp_path / "packed") if f.startswith("part-"))
    assert stored_bytes(spark, f"{tmp_path}/packed") == 3 * size and stored_bytes(spark, f"{tmp_path}/plain") > size


def test_sources_of_the_mart_queries_are_compressed(spark, tmp_path):
    from spark_checks.inputs import as_csv

    path = as_csv(spark.range(5).selectExpr("cast(id as string) as k"), "t")
    assert all(f.endswith(".csv.gz") for f in read_csv(spark, path).inputFiles()) and read_csv(spark, path).count() == 5
