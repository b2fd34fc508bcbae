import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from billbook import schemas as S
from billbook.functions import (
    days_late,
    days_late_as_of,
    delay_band,
    delay_band_filter,
    minimum_behaviour,
    months_between,
    parse_date,
    parse_id,
    payment_status,
    payment_status_total,
    ref_from_text,
    truncated_months,
    value_band,
)

D = dt.date


def test_parse_id_strips_non_digits(spark):
    df = spark.createDataFrame([("FAT-001",), ("abc",), ("12.0",), ("-7",)], "s string")
    got = [r[0] for r in df.select(parse_id("s")).collect()]
    assert got == [1, None, 120, 7]


def test_parse_date_bad_text_is_null(spark):
    df = spark.createDataFrame([("2023-01-05",), ("05/01/2023",), ("2023-01-05 10:11:12",)], "s string")
    assert [r[0] for r in df.select(parse_date("s")).collect()] == [D(2023, 1, 5), None, D(2023, 1, 5)]


def test_ref_from_text(spark):
    df = spark.createDataFrame([("2023-01-05",)], "s string")
    r = df.select(ref_from_text("s"), ref_from_text("s", 8)).first()
    assert tuple(r) == ("202301", "20230105")


def _status_frame(spark):
    rows = [
        # paid_on, paid, billed, due
        (D(2023, 1, 9), Decimal("100.00"), Decimal("100.00"), D(2023, 1, 10)),   # early
        (D(2023, 1, 10), Decimal("100.00"), Decimal("100.00"), D(2023, 1, 10)),  # on time
        (D(2023, 1, 11), Decimal("100.00"), Decimal("100.00"), D(2023, 1, 10)),  # late 1 day
        (D(2023, 1, 11), Decimal("50.00"), Decimal("100.00"), D(2023, 1, 10)),   # partial
        (None, None, Decimal("100.00"), D(2023, 1, 10)),                          # unpaid
        (D(2023, 1, 11), Decimal("100.00"), Decimal("100.00"), None),             # NULL due -> NULL class
        (D(2023, 1, 9), None, Decimal("100.00"), D(2023, 1, 10)),                 # NULL paid -> by date
    ]
    schema = "data_pagamento date, valor_pagamento decimal(15,2), valor_fatura decimal(15,2), data_vencimento date"
    return spark.createDataFrame(rows, schema)


def test_payment_status_pipeline(spark):
    df = _status_frame(spark).withColumn("fbc_classificacao_pagamento", payment_status())
    got = [r[0] for r in df.select("fbc_classificacao_pagamento").collect()]
    assert got == ["PAGAMENTO_ANTECIPADO", "PAGO_EM_DIA", "PAGO_EM_ATRASO", "PAGAMENTO_PARCIAL", "NAO_PAGO", None,
                   "PAGAMENTO_ANTECIPADO"]


def test_payment_status_total_has_no_null(spark):
    got = [r[0] for r in _status_frame(spark).select(payment_status_total()).collect()]
    assert got[5] == "PAGO_EM_ATRASO" and None not in got


def test_days_late_pipeline_and_ref_date(spark):
    df = _status_frame(spark).withColumn("fbc_classificacao_pagamento", payment_status())
    plain = [r[0] for r in df.select(days_late()).collect()]
    assert plain[:5] == [0, 0, 1, 0, 0]   # partial: 0; unpaid without ref date: 0
    ref = [r[0] for r in df.select(days_late(ref_date="2023-01-20")).collect()]
    assert ref[4] == 10


def test_days_late_as_of_counts_partial_delay(spark):
    df = _status_frame(spark)
    got = [r[0] for r in df.select(days_late_as_of("data_vencimento", "data_pagamento", "2023-01-20")).collect()]
    assert got[:5] == [0, 0, 1, 1, 10]


def test_months_between_month_ends_and_truncation(spark):
    df = spark.createDataFrame([(D(2023, 4, 30), D(2023, 3, 31)), (D(2023, 3, 15), D(2023, 1, 20))], "a date, e date")
    r = df.select(months_between("a", "e").alias("m"), truncated_months("a", "e").alias("t")).collect()
    assert r[0]["m"] == 1.0
    assert abs(r[1]["m"] - 1.83870968) < 1e-8 and r[1]["t"] == 1


def test_value_bands_edges(spark):
    df = spark.createDataFrame([(Decimal(x),) for x in ("1000", "3000", "5000", "5000.01")], "valor_fatura decimal(15,2)")
    got = [r[0][:2] for r in df.select(value_band()).collect()]
    assert got == ["1.", "2.", "3.", "4."]


def test_minimum_behaviour(spark):
    rows = [(Decimal("100"), Decimal("100"), Decimal("10")), (Decimal("50"), Decimal("100"), Decimal("10")),
            (Decimal("5"), Decimal("100"), Decimal("10"))]
    df = spark.createDataFrame(rows, "valor_pagamento decimal(15,2), valor_fatura decimal(15,2), valor_pagamento_minimo decimal(15,2)")
    assert [r[0] for r in df.select(minimum_behaviour()).collect()] == [S.BEHAVIOUR_FULL, S.BEHAVIOUR_MIN, S.BEHAVIOUR_BELOW]


def test_delay_bands_and_filter(spark):
    df = spark.createDataFrame([(S.STATUS_LATE, d) for d in (30, 31, 90, 91)] + [(S.STATUS_PARTIAL, 0)],
                               "status string, dias_atraso int")
    got = [r[0][:2] for r in df.select(delay_band()).collect()]
    assert got == ["2.", "3.", "3.", "4.", "2."]
    # the drill-down filter starts at > 0 days, so the 0-day partial is not in band 2
    assert df.where(delay_band_filter(S.DELAY_BANDS[0][1])).count() == 1
    assert df.where(F.col("dias_atraso") > 0).where(delay_band_filter(S.DELAY_BANDS[2][1])).count() == 1
