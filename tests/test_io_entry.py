import os

from pyspark.sql import functions as F

from billbook import schemas as S
from billbook.plans.trusted import load_trusted, trusted_invoices
from billbook.sources import lake, raw
from billbook.sources.bindings import raw_invoice_text, read_table


def test_trusted_invoices_edge_text(spark):
    rows = [("7", "FAT-001", "2023-01-05", "2023-02-04", "100.50"),
            ("8", "abc", "05/01/2023", "2023-02-04", "x"),
            ("9", "12.0", "2023-03-01 08:00:00", "2023-03-31", "5")]
    df = trusted_invoices(spark.createDataFrame(rows, S.RAW_INVOICE), "run").collect()
    assert [r.id_fatura for r in df] == [1, None, 120]
    assert df[1].data_emissao is None and df[1].valor_fatura is None
    assert df[1].ref == "05/01/"          # ref comes from the raw text, as defined
    assert df[2].ref == "202303" and str(df[0].valor_pagamento_minimo) == "0.00"


def test_load_trusted_roundtrip(spark, sf_small, tmp_path):
    orders = read_table(spark, sf_small, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    root = str(tmp_path)
    rep = load_trusted(raw_invoice_text(orders), "fatura", "20020101000000", f"{root}/trusted/tb_01_fatura",
                       f"{root}/qualidade", f"{root}/controle", "tb_faturas.csv")
    assert rep["status"] == "OK" and rep["total_registros"] == orders.count()
    back = lake.read_table(spark, f"{root}/trusted/tb_01_fatura", S.INVOICES)
    assert back.count() == orders.count()
    load_trusted(raw_invoice_text(orders), "fatura", "20020101000000", f"{root}/trusted/tb_01_fatura")
    back = lake.read_table(spark, f"{root}/trusted/tb_01_fatura", S.INVOICES)
    assert back.count() == orders.count()  # the same load again replaces itself
    assert dict(back.dtypes)["ref"] == "string"
    # partition pruning on the cohort column
    plan = back.where(F.col("ref") == "199601")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ref" in plan
    assert spark.read.parquet(f"{root}/controle").first().qtd_registros == orders.count()


def test_fallback_latest_and_file_metadata(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([("1", "FAT-1", "2023-01-05", "2023-02-04", "1.00")], S.RAW_INVOICE)
    df.write.option("header", True).csv(f"{root}/backup_02/f.csv")
    got = raw.scan_with_fallback(spark, "f.csv", [f"{root}/official", f"{root}/backup_01", f"{root}/backup_02"], S.RAW_INVOICE)
    assert got.count() == 1
    os.makedirs(f"{root}/land", exist_ok=True)
    for name, t in (("a.csv", 100), ("b.csv", 200)):
        p = f"{root}/land/{name}"
        open(p, "w").write("id_cliente\n1\n")
        os.utime(p, (t, t))
    assert raw.latest_file(spark, [f"{root}/missing", f"{root}/land"]).endswith("b.csv")
    named = f"{root}/named"
    raw.write_named_batches(df.withColumn("_ref", F.lit("202301")), named, "fatura_raw", "_ref", "20230131")
    meta = raw.with_file_metadata(raw.read_csv(spark, named + "/*.csv", S.RAW_INVOICE)).first()
    assert (meta.ref, meta.ts_file_generation) == ("202301", "20230131")


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert len(df.columns) == 203 and df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    from billbook.plans.catalog import QUERIES
    assert set(QUERIES) <= set(o) <= set(q)  # training-data queries may have no SQL


def test_sample_queries_match_oracle(spark, sf_small):
    from billbook.plans.catalog import QUERIES
    from oracle.queries import ORACLE
    from tools.compare import compare, duck

    con = duck(sf_small)
    for name in ["mart_kpis", "churn_evolution", "status_distribution", "integrity_report", "book_by_client",
                 "inactive_clients", "top_risk_clients", "client_recent_6", "trusted_invoices"]:
        r = compare(QUERIES[name](spark, sf_small), ORACLE[name], con)
        assert r["ok"], (name, r)


def test_output_date_mapping_matches_spark_schemas(spark, sf_small):
    from pyspark.sql.types import DateType, TimestampNTZType

    from billbook.plans.catalog import QUERIES, RAW_QUERIES
    from oracle.queries import OUTPUT_DATES

    for name in ["view_integrated", "trusted_invoices_daily", "client_lifetime", "scan_csv_raw", "ref_from_text",
                 "book_by_cohort", "churn_evolution"]:
        raw_dates = [f.name for f in RAW_QUERIES[name](spark, sf_small).schema.fields if isinstance(f.dataType, DateType)]
        assert raw_dates == OUTPUT_DATES.get(name, []), name
        out = QUERIES[name](spark, sf_small).schema
        assert all(isinstance(out[c].dataType, TimestampNTZType) for c in raw_dates)


def test_failed_load_leaves_table_untouched(spark, tmp_path):
    import pytest

    from billbook.operators.observability import IntegrityError

    root = str(tmp_path)
    row = ("1", "FAT-1", "2023-01-05", "2023-02-04", "10.00")
    raw_rows = spark.createDataFrame([row, row], S.RAW_INVOICE)          # duplicate key
    with pytest.raises(IntegrityError):
        load_trusted(raw_rows, "fatura", "20230101000000", f"{root}/tb", f"{root}/q", f"{root}/c", "x.csv")
    q = spark.read.parquet(f"{root}/q").first()
    assert q.status == "FALHOU" and q.chaves_duplicadas == 1
    assert not [p for p in os.listdir(f"{root}/tb") if not p.startswith("_")]   # nothing published
    assert not os.path.exists(f"{root}/c")                                      # no lineage for a failed load
