"""Run registered queries beside their SQL and compare every row.

    python -m testbed.compare [--sf-dir DIR] [query ...]
"""

import argparse
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("gridlake-checks")
        .config("spark.sql.shuffle.partitions", cores).config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.dataFrameQueryContext.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(df, db, sql: str) -> tuple[int, list]:
    """Row count, and what differs: columns, counts or up to three rows."""
    names = sorted(df.columns)
    relation = db.sql(sql)
    if names != sorted(relation.columns):
        return 0, [f"columns {names} against {sorted(relation.columns)}"]
    ours = _sorted([tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()])
    quoted = ", ".join(f'"{n}"' for n in names)
    theirs = _sorted(db.sql(f"select {quoted} from ({sql})").fetchall())
    if len(ours) != len(theirs):
        return len(ours), [f"{len(ours)} rows against {len(theirs)}"]
    return len(ours), [f"{a} != {b}" for a, b in zip(ours, theirs) if a != b]


def main() -> None:
    from testbed.oracle import ORACLE
    from testbed.queries import QUERIES

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    parser.add_argument("queries", nargs="*")
    args = parser.parse_args()
    spark, db = session(), database(args.sf_dir)
    failed = []
    for name in args.queries or QUERIES:
        start = time.time()
        try:
            n, diff = differences(QUERIES[name](spark, args.sf_dir), db, ORACLE[name])
        except Exception as error:  # report and go on with the next query
            n, diff = 0, [f"{type(error).__name__}: {str(error)[:1500]}"]
        print(f"{'FAIL' if diff else 'ok  '} {name:24} {n:8} rows {time.time() - start:6.2f} s", flush=True)
        if diff:
            failed.append(name)
            print(f"     {len(diff)} differences", *diff[:3], sep="\n     ", flush=True)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
