"""Table contracts and domain constants."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(15, 2)

# ---------------------------------------------------------------------------
# FIXED VALUES — these must equal the source system's values for results to
# match (table column names, class codes, window names, labels, message
# formats). Kept together, in their natural order.
# ---------------------------------------------------------------------------

# Payment classes of the pipeline, in book order.
CLASSES = ["PAGO_EM_ATRASO", "NAO_PAGO", "PAGO_EM_DIA", "PAGAMENTO_ANTECIPADO", "PAGAMENTO_PARCIAL"]

# Book windows: name -> months of look-back (None = whole cohort).
WINDOWS = {"total": None, "u1m": 1, "u3m": 3, "u6m": 6, "u12m": 12}

# Payment status labels of the marts.
STATUS_UNPAID = "Inadimplente"
STATUS_PARTIAL = "Pagamento Parcial"
STATUS_EARLY = "Pagamento Antecipado"
STATUS_ON_TIME = "Pagamento em Dia"
STATUS_LATE = "Em Atraso"

# Retention categories.
RET_INACTIVE = "Inativo / Churn"
RET_ON_TIME = "Ativo em Dia"
RET_LATE = "Ativo em Atraso"

# Invoice value bands (upper edges inclusive) and labels.
VALUE_BANDS = [
    (1000, "1. Até R$ 1k"),
    (3000, "2. R$ 1k a R$ 3k"),
    (5000, "3. R$ 3k a R$ 5k"),
    (None, "4. Acima de R$ 5k"),
]

# Minimum-payment behaviour labels.
BEHAVIOUR_FULL = "Pagamento Integral"
BEHAVIOUR_MIN = "Pagou Mínimo / Parcial"
BEHAVIOUR_BELOW = "Abaixo do Mínimo / Nulo"

# Delay bands: labels and upper edges (days, inclusive).
DELAY_BAND_ON_TIME = "1. Em Dia / Antecipado"
DELAY_BANDS = [
    (30, "2. Atraso Leve (1-30d)"),
    (90, "3. Atraso Moderado (31-90d)"),
    (None, "4. Inadimplente (>90d)"),
]

# Integrity report statuses and failure message formats.
CHECK_OK = "OK"
CHECK_FAILED = "FALHOU"
MSG_DUPLICATES = "{n} chave(s) duplicada(s) em {keys}"
MSG_NULLS = "{n} nulo(s) na coluna obrigatória '{col}'"
MSG_RECONCILE = "reconciliação falhou: esperado ~{expected}, obtido {total} (diff={diff})"
MSG_SEPARATOR = "; "

# ---------------------------------------------------------------------------

RAW_INVOICE = StructType([
    StructField("id_cliente", StringType()),
    StructField("id_fatura", StringType()),
    StructField("dt_emissao_fatura", StringType()),
    StructField("dt_vencimento_fatura", StringType()),
    StructField("valor_fatura", StringType()),
])

RAW_PAYMENT = StructType([
    StructField("id_cliente", StringType()),
    StructField("id_fatura", StringType()),
    StructField("id_pagamento", StringType()),
    StructField("dt_pagamento", StringType()),
    StructField("valor_pagamento", StringType()),
])

INVOICES = StructType([
    StructField("ref", StringType()),
    StructField("dt_proc", StringType()),
    StructField("id_cliente", LongType()),
    StructField("id_fatura", LongType()),
    StructField("data_emissao", DateType()),
    StructField("data_vencimento", DateType()),
    StructField("valor_fatura", MONEY),
    StructField("valor_pagamento_minimo", MONEY),
])

PAYMENTS = StructType([
    StructField("ref", StringType()),
    StructField("dt_proc", StringType()),
    StructField("id_cliente", LongType()),
    StructField("id_fatura", LongType()),
    StructField("id_pagamento", LongType()),
    StructField("data_pagamento", DateType()),
    StructField("valor_pagamento", MONEY),
])

STAGE = StructType([
    StructField("ref", StringType()),
    StructField("dt_proc", StringType()),
    StructField("id_cliente", LongType()),
    StructField("fbc_classificacao_pagamento", StringType()),
    StructField("data_emissao", DateType()),
    StructField("fvl_valor_fatura", MONEY),
    StructField("fvl_numero_dias_atraso", IntegerType()),
    StructField("fvl_qtd_transacoes", IntegerType()),
])

LINEAGE = StructType([
    StructField("tabela", StringType()),
    StructField("dt_proc", StringType()),
    StructField("qtd_registros", LongType()),
    StructField("camada_origem", StringType()),
    StructField("arquivo_origem", StringType()),
    StructField("executado_em", StringType()),
])

QUALITY = StructType([
    StructField("tabela", StringType()),
    StructField("dt_proc", StringType()),
    StructField("status", StringType()),
    StructField("falhas", StringType()),
    StructField("total_registros", LongType()),
    StructField("chaves_duplicadas", LongType()),
])

INVOICE_KEYS = ["id_cliente", "id_fatura"]
