"""Run queries on Spark and their SQL on DuckDB and compare: ``python -m checks.compare [dir] [name ...]``."""

from __future__ import annotations

import sys
import tempfile
import time
import traceback

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session(cores: str = "8"):
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("docmonitor-checks")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    if not spark.conf.get("spark.checkpoint.dir", ""):  # one machine: any folder is shared
        spark.stop()
        spark = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="docmonitor-")).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted(
        (tuple(row[i] for i in order) for row in rows), key=lambda r: tuple(map(repr, r))
    )


def compare(spark, con, sf_dir, name, query, sql):
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got[1] else "no rows"
    done = con.execute(sql)
    want = rows_of([d[0] for d in done.description], done.fetchall())
    if got == want:
        return None if got[1] else "equal but empty"
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    only_got, only_want = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
    return (f"rows {len(got[1])} vs {len(want[1])}; only spark {sorted(map(repr, only_got))[:2]}; "
            f"only sql {sorted(map(repr, only_want))[:2]}")


def main(argv):
    sys.path.insert(0, ".")
    from checks.oracle import ORACLE
    from checks.queries import QUERIES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark, con, bad = session(), database(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name, QUERIES[name], ORACLE.get(name))
        except Exception as error:  # reported per query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
            if "-v" in argv:
                traceback.print_exc()
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main(sys.argv[1:])
