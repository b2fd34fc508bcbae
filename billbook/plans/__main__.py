"""``python -m billbook.plans --lake-root PATH [--ref-date yyyy-MM-dd]``"""

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from billbook.plans.book_pipeline import run_pipeline
from billbook.session import apply_defaults


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--lake-root", required=True)
    ap.add_argument("--ref-date", default=None)
    ap.add_argument("--dt-proc", default=dt.datetime.now().strftime("%Y%m%d%H%M%S"))
    a = ap.parse_args()
    spark = apply_defaults(SparkSession.builder.appName("billbook").getOrCreate())
    print(run_pipeline(spark, a.lake_root, a.dt_proc, a.ref_date))


if __name__ == "__main__":
    main()
