"""Run named queries beside their SQL and compare: columns, types, row count, every value.

    python tools/check_oracles.py [folder] [name ...]
"""

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tieout.plans.oracles import ORACLES  # noqa: E402
from tieout.plans.registry import QUERIES  # noqa: E402
from tieout.session import local_session  # noqa: E402

SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def same_type(spark_type: str, duck_type: str) -> bool:
    return SPARK_TYPES.get(spark_type, spark_type.upper()) == duck_type.replace(", ", ",")


def compare(spark, con, folder: str, name: str) -> list[str]:
    df = QUERIES[name](spark, folder)
    rel = con.sql(ORACLES[name])
    ours, theirs = dict(df.dtypes), dict(zip(rel.columns, map(str, rel.types), strict=True))
    problems = []
    if set(ours) != set(theirs):
        return [f"columns differ: {sorted(set(ours) ^ set(theirs))}"]
    for c, kind in ours.items():
        if not same_type(kind, theirs[c]):
            problems.append(f"{c}: {kind} vs {theirs[c]}")
    order = sorted(ours)
    left = [tuple(r[c] for c in order) for r in df.collect()]
    at = [rel.columns.index(c) for c in order]
    right = [tuple(r[i] for i in at) for r in rel.fetchall()]
    if len(left) != len(right):
        problems.append(f"rows {len(left)} vs {len(right)}")
    a, b = Counter(left), Counter(right)
    if a != b:
        problems.append(f"values differ: {list((a - b).items())[:2]} / {list((b - a).items())[:2]}")
    if not left:
        problems.append("note: no rows")
    return problems


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    con = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    missing = set(QUERIES) ^ set(ORACLES)
    print(f"{len(QUERIES)} queries; without a partner: {sorted(missing)}")
    bad = 0
    for name in names:
        start = time.time()
        try:
            problems = compare(spark, con, folder, name)
        except Exception as e:  # report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        real = [p for p in problems if not p.startswith("note")]
        bad += bool(real)
        print(f"{'BAD ' if real else 'ok  '}{name} {time.time() - start:.1f}s {problems or ''}", flush=True)
    print(f"{bad} bad of {len(names)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
