import pytest
from pyspark.sql import functions as F

from billbook.plans.book_pipeline import run_book, run_pipeline
from billbook.sinks import commits
from billbook.sources.bindings import load_tables, raw_invoice_text, raw_payment_text
from billbook.sources.lake import read_table


def test_pipeline_end_to_end(spark, sf_small, tmp_path):
    root = str(tmp_path / "lake")
    t = load_tables(spark, sf_small)
    # land raw files: invoices in the official folder, payments only in backup_01
    raw_invoice_text(t.invoices.select(
        F.col("id_cliente").alias("o_custkey"), F.col("id_fatura").alias("o_orderkey"),
        F.col("valor_fatura").cast("double").alias("o_totalprice"), F.col("data_emissao").alias("o_orderdate"),
    )).write.option("header", True).csv(f"{root}/raw/fatura/tb_faturas_1.csv")
    dedup_payments = t.payments.dropDuplicates(["id_pagamento"])
    raw_payment_text(dedup_payments).write.option("header", True).csv(f"{root}/raw/backup_01/pagamento/tb_pagamentos_1.csv")

    rep = run_pipeline(spark, root, "20020101000000")
    assert rep.invoices["status"] == "OK" and rep.payments["status"] == "OK" and rep.book["status"] == "OK"
    book = read_table(spark, f"{root}/refined/book_fatura")
    assert book.count() == rep.book["total_registros"] > 0
    assert read_table(spark, f"{root}/refined/stage_fatura").count() == t.invoices.count()
    q = spark.read.parquet(f"{root}/qualidade")
    assert sorted(r.tabela for r in q.collect()) == ["book_fatura", "tb_01_fatura", "tb_02_pagamento"]
    assert spark.read.parquet(f"{root}/controle").count() == 3
    control = spark.read.parquet(f"{root}/controle_book").collect()
    assert [(r.assunto, r.ref, r.ts_proc, r.qtd_registros) for r in control] == [("book_fatura", "20020101", "20020101000000", book.count())]


STEPS = {  # where a run can break, by the function that raises after (or instead of) its work
    "stage written": ("billbook.sinks.commits.write_run", 1, True),
    "book written": ("billbook.sinks.commits.write_run", 2, True),
    "before the record has its name": ("billbook.sinks.commits.rename", 1, False),
    "after the record": ("billbook.sinks.commits.rename", 1, True),
}


def _tables_of(spark, root):
    stage, book = (read_table(spark, f"{root}/refined/{t}", None) for t in ("stage_fatura", "book_fatura"))
    keys = book.groupBy("ref", "id_cliente").count().filter("count > 1").count()
    return stage.count(), book.count(), keys


@pytest.mark.parametrize("step", list(STEPS))
def test_book_rerun_after_a_break_anywhere(spark, sf_small, tmp_path, monkeypatch, step):
    """Broken at any step and run again with its ``dt_proc``: one stage row
    per invoice, one book row per key; until then readers see both tables as
    they were, or both new."""
    import importlib

    root = str(tmp_path / "lake")
    t = load_tables(spark, sf_small)
    few = "ref between '199601' and '199603'"
    t.invoices.where(few).write.partitionBy("ref").parquet(f"{root}/trusted/tb_01_fatura")
    t.payments.where(few).write.partitionBy("ref").parquet(f"{root}/trusted/tb_02_pagamento")
    run_book(spark, root, "20020101000000")
    before = _tables_of(spark, root)
    where, call, after = STEPS[step]
    module, name = importlib.import_module(where.rpartition(".")[0]), where.rpartition(".")[2]
    real, calls = getattr(module, name), []

    def broken(*args, **kwargs):
        calls.append(1)
        out = real(*args, **kwargs) if len(calls) != call or after else None
        if len(calls) == call:
            raise OSError("lost")
        return out

    monkeypatch.setattr(module, name, broken)
    with pytest.raises(OSError):
        run_book(spark, root, "20020201000000")
    monkeypatch.setattr(module, name, real)
    n = t.invoices.where(few).count()
    seen = _tables_of(spark, root)
    published = step == "after the record"
    assert seen[0] == (2 * n if published else n) and seen[1] == (2 if published else 1) * before[1]
    assert run_book(spark, root, "20020201000000")["status"] == "OK"
    assert _tables_of(spark, root)[:2] == (2 * n, 2 * before[1])
    newest = read_table(spark, f"{root}/refined/book_fatura").where("dt_proc = '20020201000000'")
    assert newest.groupBy("ref", "id_cliente").count().filter("count > 1").count() == 0


def test_book_run_twice_replaces_itself(spark, sf_small, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    def count(self):
        raise AssertionError("rows are counted as they are written, not by a job")

    root = str(tmp_path / "lake")
    t = load_tables(spark, sf_small)
    t.invoices.write.partitionBy("ref").parquet(f"{root}/trusted/tb_01_fatura")
    t.payments.write.partitionBy("ref").parquet(f"{root}/trusted/tb_02_pagamento")
    first = run_book(spark, root, "20020101000000")
    with monkeypatch.context() as m:
        m.setattr(Classic, "count", count)
        assert run_book(spark, root, "20020101000000") == first
    assert _tables_of(spark, root) == (t.invoices.count(), first["total_registros"], 0)
    assert commits.published_rows(spark, f"{root}/refined") == {"stage_fatura": t.invoices.count(), "book_fatura": first["total_registros"]}
    # The replaced run is still there for those who read it, until it is old.
    table = f"{root}/refined/stage_fatura"
    assert commits.vacuum(spark, table) == [] and len(commits.vacuum(spark, table, keep_hours=-1)) == 1
    assert _tables_of(spark, root)[0] == t.invoices.count()
    read = read_table(spark, table).where("ref = '199601'")._jdf.queryExecution().executedPlan().toString()
    assert "ref#" in read.split("PartitionFilters")[1].split("]")[0]


def test_book_of_no_invoices(spark, sf_small, tmp_path):
    root = str(tmp_path / "lake")
    t = load_tables(spark, sf_small)
    t.invoices.limit(0).write.parquet(f"{root}/trusted/tb_01_fatura")
    t.payments.limit(0).write.parquet(f"{root}/trusted/tb_02_pagamento")
    assert run_book(spark, root, "20020101000000")["total_registros"] == 0
    assert commits.published_rows(spark, f"{root}/refined") == {"stage_fatura": 0, "book_fatura": 0}


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    from pyspark.sql.types import StringType, StructField, StructType

    from billbook.sources.raw import read_csv

    schema = StructType([StructField(c, StringType()) for c in ("id_cliente", "id_fatura")])
    (tmp_path / "a.csv").write_text("id_fatura,more,id_cliente\nF7,x,42\n")
    (tmp_path / "b.csv").write_text("id_cliente,id_fatura\n43,F8\n")
    (tmp_path / "c.csv").write_text("id_cliente,other\n43,F8\n")
    rows = read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], schema).collect()
    assert sorted(map(tuple, rows)) == [("42", "F7"), ("43", "F8")]
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path / "c.csv"), schema)


def test_churn_counts_a_month_without_clients(spark):
    import datetime as dt

    from billbook.operators.marts import churn_evolution

    rows = [(1, dt.date(2001, 1, 1), 1, "Pago em Dia"), (None, dt.date(2001, 2, 1), 2, "Pago em Dia")]
    vw = spark.createDataFrame(rows, "id_cliente long, data_referencia date, id_fatura long, status string")
    got = {(r["mes_ano"], r["categoria_retencao"]): r["qtd_clientes"] for r in churn_evolution(vw).collect()}
    assert got == {("01/2001", "Ativo em Dia"): 1, ("02/2001", "Inativo / Churn"): 1}


def test_latest_runs_is_whole_by_default(spark):
    from billbook.sources.lake import latest_runs

    audit = spark.createDataFrame([(f"{i:014d}", "t") for i in range(50)], "dt_proc string, tabela string")
    assert latest_runs(audit).count() == 50 and latest_runs(audit, 20).count() == 20
