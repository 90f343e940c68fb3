"""Run queries next to their SQL and compare column names, types and all values."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return db


def _rows(table) -> list[str]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(repr(r) for r in zip(*columns)) if columns else []


def _type(t) -> str:
    text = str(t).replace("large_", "").replace("[us, tz=UTC]", "[us]")
    return text.replace("timestamp[us, tz=Etc/UTC]", "timestamp[us]")


def compare(spark, db, name, run, sql, folder) -> str | None:
    """None when equal, else what differs."""
    df = run(spark, folder)
    ours = df.toArrow()
    theirs = db.execute(sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(ours.column_names)} / {sorted(theirs.column_names)}"
    types = [
        f"{n}: {_type(ours.schema.field(n).type)} / {_type(theirs.schema.field(n).type)}"
        for n in ours.column_names
        if _type(ours.schema.field(n).type) != _type(theirs.schema.field(n).type)
    ]
    a, b = _rows(ours), _rows(theirs)
    if a != b:
        only_a = [x for x in a if x not in set(b)][:2]
        only_b = [x for x in b if x not in set(a)][:2]
        return f"rows {len(a)} / {len(b)}; only ours {only_a}; only SQL {only_b}; types {types}"
    return f"types {types}" if types else None


def main(folder: str, wanted: list[str]) -> int:
    from civiclake.plans.session import build_session
    from civiclake.queries import ORACLES, QUERIES

    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
        },
    )
    db = connect(folder)
    bad = 0
    for name, run in QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, db, name, run, ORACLES[name], folder)
                n = ""
            else:
                problem, n = None, f"rows only: {run(spark, folder).count()}"
        except Exception as e:  # noqa: BLE001 - report and go on
            problem, n = f"{type(e).__name__}: {str(e)[:1500]}", ""
        bad += problem is not None
        print(f"{'BAD' if problem else 'ok '} {time.time() - start:6.2f}s {name} {n}{problem or ''}", flush=True)
    print("problems:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
