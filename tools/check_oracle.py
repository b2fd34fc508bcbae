"""Run every registered query against its DuckDB oracle.

usage: python -m tools.check_oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import sys
import time

from billbook.plans.catalog import QUERIES
from billbook.session import local_session
from oracle.queries import ORACLE
from tools.compare import compare, duck


def main(argv: list[str]) -> int:
    import tools.compare as C

    if argv and argv[0] == "--strict":
        C.STRICT = True
        argv = argv[1:]
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = local_session(8)
    con = duck(sf)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf)
            if name in ORACLE:
                r = compare(df, ORACLE[name], con)
            else:
                r = {"rows": df.count(), "ok": True, "oracle": "none"}
        except Exception as e:  # report and continue
            r = {"ok": False, "error": f"{type(e).__name__}: {str(e)[:300]}"}
        r["sec"] = round(time.time() - t0, 2)
        bad += not r.get("ok")
        print(name, json.dumps(r, default=str), flush=True)
    print(f"FAILED {bad} of {len(names)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
