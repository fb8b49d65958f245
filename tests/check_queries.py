"""Run queries against their SQL: ``python tests/check_queries.py [folder] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.oracle import compare, connect  # noqa: E402
from tidemark.registry import ORACLES, QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402


def main() -> int:
    args = sys.argv[1:]
    folder = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = args or list(QUERIES)
    names = [q for q in QUERIES if any(q == n or (n.endswith("*") and q.startswith(n[:-1])) for n in names)] if args else names
    spark, con = local_session(), connect(folder)
    failed = 0
    for name in names:
        began = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLES:
                problems = compare(df, con, ORACLES[name])
                note = "ok" if not problems else "BAD"
            else:
                problems, note = [], f"rows {df.count()}"
        except Exception as error:  # noqa: BLE001
            problems, note = [f"{type(error).__name__}: {str(error)[:700]}"], "ERR"
        failed += bool(problems)
        if problems or args:
            print(f"{name}: {note} {time.time() - began:.1f}s", *problems, sep="\n   ", flush=True)
    print(f"{len(names)} queries, {failed} failed", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
