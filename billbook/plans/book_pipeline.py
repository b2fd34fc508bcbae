"""Book build: dedup -> join -> class -> days late -> stage -> book."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from billbook.operators.book import book_by_cohort, book_tasks, heavy_clients
from billbook.operators.joins import LOOK, classified, invoice_payment_join, latest_invoices, latest_payments, stage_invoices


def invoices_for_cohort(invoices: DataFrame, ref_date: str) -> DataFrame:
    """Invoices of the cohort month of ``ref_date`` (``yyyy-MM-dd``).

    A filter on the ``ref`` partition column: partition pruning on a lake
    table, a pushed filter on a file scan.
    """
    ym = ref_date.replace("-", "")[:6]
    return invoices.where(F.col("ref") == F.lit(ym))


def lookback(daily: DataFrame, since_ref: str) -> DataFrame:
    """Rows of a daily table (invoices or payments) whose ``ref`` (yyyyMMdd)
    is at or after ``since_ref`` (string compare on the partition column, so
    it prunes partitions)."""
    return daily.where(F.col("ref") >= F.lit(since_ref))


@dataclass
class BookResult:
    stage: DataFrame
    dt_proc: str
    ref_date: str | None = None
    heavy: Sequence[int | None] = ()
    tasks: int | None = None

    @property
    def book(self) -> DataFrame:
        """Built on first use, so callers that need only the stage do not
        pay for constructing the 200-column plan."""
        return book_by_cohort(self.stage, self.dt_proc, anchor=self.ref_date, heavy=self.heavy, tasks=self.tasks)


def build_book(invoices: DataFrame, payments: DataFrame, dt_proc: str, ref_date: str | None = None,
               seen: Observation | None = None, heavy: Sequence[int | None] = (), tasks: int | None = None) -> BookResult:
    """The book plan. With ``ref_date`` the invoices are cut to that cohort,
    unpaid delay is measured to ``ref_date`` and windows are anchored on it;
    without it each client's newest emission date anchors its windows.
    ``seen`` counts the deduplicated invoices as they pass (``invoices``);
    ``heavy`` clients are combined before they are dealt out, the others are
    dealt to ``tasks`` tasks."""
    inv = invoices if ref_date is None else invoices_for_cohort(invoices, ref_date)
    pay = payments
    if ref_date is not None:
        # Only payments of the cohort's invoices can match the left join:
        # a semi join on the invoice key before the payment dedup (whose
        # partitioning it shares) skips deduplicating every other payment.
        # AQE turns it into a broadcast when the cohort's keys are small.
        pay = payments.join(inv.select("id_cliente", "id_fatura"), ["id_cliente", "id_fatura"], "left_semi")
    newest = latest_invoices(inv)
    if seen is not None:
        newest = newest.observe(seen, F.count(F.lit(1)).alias("invoices"))
    joined = invoice_payment_join(newest, latest_payments(pay))
    stage = stage_invoices(classified(joined, ref_date), dt_proc)
    return BookResult(stage=stage, dt_proc=dt_proc, ref_date=ref_date, heavy=heavy, tasks=tasks)


@dataclass
class PipelineReport:
    invoices: dict
    payments: dict
    book: dict


def layer(lake_root: str, *parts: str) -> str:
    return "/".join([lake_root.rstrip("/"), *parts])


def run_book(spark, lake_root: str, dt_proc: str, ref_date: str | None = None) -> dict:
    """Build, check and publish the stage and the book from the trusted
    tables under ``lake_root``.

    The stage is written first, as a run that no reader sees, and the book is
    computed from those files: the long dedup/join lineage is cut by a table on
    the shared file system, so a lost executor only recomputes from the stage.
    Rows are counted as they pass, not by jobs of their own. The book is
    checked from its written files; only when the check passes does one commit
    record publish both tables (check first, then publish both). A run broken
    anywhere leaves what was published before; a run repeated with its
    ``dt_proc`` replaces its own stage and book. Quality rows are appended
    either way, lineage and control rows on success.
    """
    from billbook.operators.book import BOOK_KEYS
    from billbook.operators.observability import IntegritySpec, book_control_row, check_integrity, lineage_row, record_lineage
    from billbook.schemas import INVOICE_KEYS, INVOICES, PAYMENTS, STAGE
    from billbook.sinks.commits import commit, drop_run, new_run, read_runs, write_run
    from billbook.sinks.parquet import append_rows
    from billbook.sources.lake import read_table

    invoices = read_table(spark, layer(lake_root, "trusted", "tb_01_fatura"), INVOICES)
    payments = read_table(spark, layer(lake_root, "trusted", "tb_02_pagamento"), PAYMENTS)
    stage_table, book_table = (layer(lake_root, "refined", t) for t in ("stage_fatura", "book_fatura"))
    run = new_run(dt_proc)
    try:
        seen = Observation(f"invoices_{run}")
        staged = write_run(build_book(invoices, payments, dt_proc, ref_date, seen).stage, stage_table, run)
        if staged.rows != (seen.get.get("invoices") or 0):
            # A task run again after a lost executor may be counted twice on
            # the way in: only then are the invoice keys counted on their own.
            source = invoices if ref_date is None else invoices_for_cohort(invoices, ref_date)
            expected = source.select(*INVOICE_KEYS).distinct().count()
            if staged.rows != expected:
                raise ValueError(f"stage_fatura: {staged.rows} rows staged, {expected} invoices expected")
        stage = read_runs(spark, stage_table, [run], STAGE)
        plan = build_book_from_stage(stage, dt_proc, ref_date, staged.rows)
        book = write_run(plan, book_table, run)
        report = check_integrity(read_runs(spark, book_table, [run], plan.schema), "book_fatura", dt_proc,
                                 IntegritySpec(BOOK_KEYS, BOOK_KEYS, expected=book.rows), layer(lake_root, "qualidade"))
    except Exception:
        drop_run(spark, stage_table, run)
        drop_run(spark, book_table, run)
        raise
    commit(spark, f"book-{dt_proc}", dt_proc, [staged, book])
    record_lineage(layer(lake_root, "controle"),
                   lineage_row(spark, "book_fatura", dt_proc, book.rows,
                               "trusted/tb_01_fatura + tb_02_pagamento", "safras_consolidadas"))
    append_rows(book_control_row(spark, "book_fatura", (ref_date or dt_proc).replace("-", "")[:8], dt_proc, book.rows), layer(lake_root, "controle_book"))
    return report


def build_book_from_stage(stage: DataFrame, dt_proc: str, ref_date: str | None = None, rows: int | None = None) -> DataFrame:
    """The book of a written stage of ``rows`` rows (counted, if not given);
    heavy clients are found in a sample of it."""
    tasks = book_tasks(stage.sparkSession, stage.count() if rows is None else rows)
    return book_by_cohort(stage, dt_proc, anchor=ref_date,
                          heavy=heavy_clients(stage.select("id_cliente").sample(LOOK, seed=7), LOOK), tasks=tasks)


def run_pipeline(spark, lake_root: str, dt_proc: str, ref_date: str | None = None) -> PipelineReport:
    """The whole batch in one session: newest raw invoice and payment files
    (official folder, then backups) -> trusted tables -> stage and book."""
    from billbook.plans.trusted import load_trusted
    from billbook.schemas import RAW_INVOICE, RAW_PAYMENT
    from billbook.sources.raw import latest_entry, read_csv

    reports = {}
    for kind, folder, schema in (("fatura", "fatura", RAW_INVOICE), ("pagamento", "pagamento", RAW_PAYMENT)):
        candidates = [layer(lake_root, "raw", folder), layer(lake_root, "raw", "backup_01", folder),
                      layer(lake_root, "raw", "backup_02", folder)]
        src = latest_entry(spark, candidates)
        table = "tb_01_fatura" if kind == "fatura" else "tb_02_pagamento"
        reports[kind] = load_trusted(read_csv(spark, src, schema), kind, dt_proc, layer(lake_root, "trusted", table),
                                     layer(lake_root, "qualidade"), layer(lake_root, "controle"), src.rsplit("/", 1)[-1])
    book = run_book(spark, lake_root, dt_proc, ref_date)
    return PipelineReport(reports["fatura"], reports["pagamento"], book)
