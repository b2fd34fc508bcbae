"""What one task is dealt stays bounded as the tables grow."""

from __future__ import annotations

import datetime as dt

from billbook.operators import book as B
from billbook.schemas import STAGE
from billbook.session import apply_defaults

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
SPLIT = "spark.sql.files.maxPartitionBytes"


def test_defaults_deal_small_partitions_unless_the_cluster_says_otherwise(spark):
    session = spark.newSession()
    session.conf.unset(ADVISORY)
    assert apply_defaults(session).conf.get(ADVISORY) == "16m"
    session.conf.set(ADVISORY, "8m")
    assert apply_defaults(session).conf.get(ADVISORY) == "8m"


def test_defaults_scan_small_splits_unless_the_cluster_says_otherwise(spark):
    session = spark.newSession()
    session.conf.unset(SPLIT)
    assert apply_defaults(session).conf.get(SPLIT) == "16m"
    session.conf.set(SPLIT, "8m")
    assert apply_defaults(session).conf.get(SPLIT) == "8m"


def test_book_is_dealt_by_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    assert B.book_tasks(spark, 0) == cores and B.book_tasks(spark, 54_000_000) >= 1080
    classes = ["PAGO_EM_DIA", "PAGO_EM_ATRASO", None]
    day = dt.date(2023, 1, 1)
    rows = [{"ref": f"20230{i % 3 + 1}", "dt_proc": "x", "id_cliente": i % 41 or None, "fbc_classificacao_pagamento": classes[i % 7 % 3],
             "data_emissao": day + dt.timedelta(days=i % 90), "fvl_valor_fatura": None, "fvl_numero_dias_atraso": i % 11, "fvl_qtd_transacoes": 1}
            for i in range(600)]
    stage = spark.createDataFrame(rows, STAGE).select(*STAGE.fieldNames())
    tasks = B.book_tasks(spark, len(rows), task_rows=600 // (3 * cores))
    assert tasks >= 3 * cores
    book = B.book_by_cohort(stage, "x", tasks=tasks)
    assert book.rdd.getNumPartitions() == tasks  # not merged again by their shuffled bytes
    assert sorted(map(repr, book.collect())) == sorted(map(repr, B.book_by_cohort(stage, "x").collect()))


def test_a_written_stage_is_dealt_by_its_rows(spark, monkeypatch):
    from billbook.plans import book_pipeline as P

    monkeypatch.setattr(P, "book_tasks", lambda spark, rows: rows + 7)
    stage = spark.createDataFrame([("202301", "x", 1, "NAO_PAGO", dt.date(2023, 1, 1), None, 0, 1)], STAGE.simpleString()[7:-1].replace(":", " "))
    assert P.build_book_from_stage(stage, "x").rdd.getNumPartitions() == 8
    assert P.build_book_from_stage(stage, "x", rows=13).rdd.getNumPartitions() == 20


def test_rows_distinct_by_a_text_id_are_sorted_by_its_hash(spark):
    from billbook.operators.dedup import distinct_by

    rows = [("PAG-1", "a"), ("PAG-2", "b"), ("PAG-1", "a"), (None, "c"), (None, "c"), ("", "d")]
    df = spark.createDataFrame(rows, "id string, _hash string")
    kept = distinct_by(df, ["id"])
    assert kept.columns == df.columns
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, df.dropDuplicates(["id"]).collect()))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert sorts and all(line.split("Sort [", 1)[1].startswith("_hash_#") for line in sorts)
