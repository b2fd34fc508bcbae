"""Folder scans by each file's header, merged table versions, audit history,
exports with a byte-order mark."""

import gzip

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from billbook.sinks import commits
from billbook.sinks.csv import export_csv
from billbook.sources import lake, raw

TWO = StructType([StructField(c, StringType()) for c in ("id_cliente", "id_fatura")])


def test_folder_of_files_with_different_headers(spark, tmp_path):
    (tmp_path / "fatura_raw_202301_20230131.csv").write_text('id_cliente,id_fatura\n1,"F,1"\n2,F2\n')
    (tmp_path / "fatura_raw_202302_20230228.csv").write_text("﻿id_fatura,more,id_cliente\nF3,x,3\n")
    (tmp_path / "fatura_raw_202303_20230331.csv").write_text("id_fatura,id_cliente\n")
    (tmp_path / "fatura_raw_202304_20230430.csv").write_text("")
    with gzip.open(tmp_path / "fatura_raw_202305_20230531.csv.gz", "wt") as f:
        f.write("id_fatura,id_cliente\nF5,5\n")
    df = raw.read_csv(spark, str(tmp_path), TWO, with_metadata=True)
    rows = sorted(tuple(r) for r in raw.with_file_metadata(df).collect())
    a, b, c = (f"fatura_raw_{x}.csv" for x in ("202301_20230131", "202302_20230228", "202305_20230531"))
    assert rows == [("1", "F,1", a, "202301", "20230131"), ("2", "F2", a, "202301", "20230131"), ("3", "F3", b, "202302", "20230228"),
                    ("5", "F5", c + ".gz", "202305", "20230531.csv.gz")]
    two_paths = raw.read_csv(spark, [str(tmp_path / a), str(tmp_path / b)], TWO, with_metadata=True)
    assert sorted(r.filename for r in raw.with_file_metadata(two_paths).collect()) == [a, a, b]
    assert raw.read_csv(spark, str(tmp_path), TWO).columns == ["id_cliente", "id_fatura"]
    assert raw.read_csv(spark, str(tmp_path / "fatura_raw_202304_20230430.csv"), TWO, with_metadata=True).count() == 0


def test_written_batches_end_in_their_stamp(spark, tmp_path):
    df = spark.createDataFrame([("1", "F1", "202301"), ("2", "F2", "202302")], "id_cliente string, id_fatura string, ref string")
    names = raw.write_named_batches(df, str(tmp_path), "fatura_raw", "ref", "20230301")
    assert sorted(n.rsplit("/", 1)[-1] for n in names) == ["fatura_raw_202301_20230301.csv", "fatura_raw_202302_20230301.csv"]


def test_export_starts_with_a_byte_order_mark(spark, tmp_path):
    df = spark.createDataFrame([("São", 1), ("b;c", 2)], "nome string, n int")
    export_csv(df, str(tmp_path / "x"))
    files = [p.read_bytes() for p in (tmp_path / "x").glob("part-*.csv") if p.stat().st_size]
    assert files and all(f.startswith(b"\xef\xbb\xbfnome;n\n") for f in files)
    back = raw.read_csv(spark, str(tmp_path / "x"), StructType([StructField("nome", StringType())]), sep=";")
    assert sorted(r.nome for r in back.collect()) == ["São", "b;c"]
    export_csv(df, str(tmp_path / "y"), mark=False)
    assert not any(p.read_bytes().startswith(b"\xef") for p in (tmp_path / "y").glob("part-*.csv"))


def test_versions_merge_from_the_records(spark, tmp_path):
    table = str(tmp_path / "t")
    versions = [("a", spark.createDataFrame([("1", 1, "x")], "ref string, n int, s string")),
                ("b", spark.createDataFrame([("1", 1 << 40, 2.5)], "ref string, n long, d double")),
                ("c", spark.createDataFrame([("2", 7)], "ref string, n int"))]
    for run, df in versions:
        commits.commit(spark, run, run, [commits.write_run(df, table, run)])
    commits.write_run(versions[0][1], table, "not-published")
    merged = lake.read_merged(spark, table)
    got = sorted((r.n, r.s, r.d, r.ref, r.filename.rsplit("/", 1)[0]) for r in merged.collect())
    assert got == [(1, "x", None, "1", "run=a/ref=1"), (7, None, None, "2", "run=c/ref=2"), (1 << 40, None, 2.5, "1", "run=b/ref=1")]
    assert dict(merged.dtypes)["n"] == "bigint"
    # A second commit under a key replaces the first.
    commits.commit(spark, "c", "c", [commits.write_run(versions[0][1], table, "c2")])
    assert lake.read_table(spark, table, merged.drop("filename").schema).where("ref = '2'").count() == 0
    with pytest.raises(ValueError):
        lake.merged_schema([spark.createDataFrame([], "x string").schema, spark.createDataFrame([], "x int").schema])


def test_a_commit_spans_tables_of_one_layer(spark, tmp_path):
    df = spark.createDataFrame([("1", 1)], "ref string, n int")
    a, b = commits.write_run(df, f"{tmp_path}/l/a", "r"), commits.write_run(df, f"{tmp_path}/m/b", "r")
    with pytest.raises(ValueError):
        commits.commit(spark, "k", "1", [a, b])
    assert lake.read_table(spark, f"{tmp_path}/l/a", df.schema).count() == 0
    with pytest.raises(FileNotFoundError):
        lake.read_table(spark, f"{tmp_path}/l/a")


def test_audit_history_numbers_runs_per_table(spark, tmp_path):
    root = str(tmp_path)
    q = [(t, f"2024010{d}", "OK", "", d, 0) for t in ("x", "y") for d in range(1, 6)]
    spark.createDataFrame(q, lake.QUALITY).write.parquet(f"{root}/qualidade")
    spark.createDataFrame([("x", "20240101", 1, "raw", "f", "now")], lake.LINEAGE).write.parquet(f"{root}/controle")
    commits.commit(spark, "k", "20240101", [commits.write_run(spark.createDataFrame([("1", 1)], "ref string, n int"), f"{root}/trusted/x", "r")])
    rows = lake.audit_history(spark, root, n=2).collect()
    assert sorted((r.registro, r.tabela, r.dt_proc, r.posicao) for r in rows) == [
        ("linhagem", "x", "20240101", 1), ("qualidade", "x", "20240104", 2), ("qualidade", "x", "20240105", 1),
        ("qualidade", "y", "20240104", 2), ("qualidade", "y", "20240105", 1), ("trusted", "x", "20240101", 1)]
    plan = lake.audit_history(spark, root, n=2).where(F.col("posicao") <= 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
