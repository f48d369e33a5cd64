"""Run registered queries next to their SQL and compare whole results."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    def cell(v):
        if isinstance(v, bool) or v is None:
            return v
        if isinstance(v, float):
            return float(f"{v:.12g}")
        if isinstance(v, int):
            return v
        return str(v)
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, sf_dir: str, names=None, show: int = 3) -> dict[str, str]:
    import duckdb

    import __spark_entry__ as entry_points
    queries, oracle = entry_points.queries(), entry_points.oracle_sql()
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    verdicts = {}
    for name in names or queries:
        begun = time.time()
        try:
            df = queries[name](spark, sf_dir)
            got = _canonical([tuple(r) for r in df.collect()], df.columns)
        except Exception as error:  # reported, not hidden: the verdict carries it
            verdicts[name] = f"ERROR {type(error).__name__}: {str(error)[:600]}"
            print(name, verdicts[name], flush=True)
            continue
        took = time.time() - begun
        if name not in oracle:
            verdicts[name] = "rows only"
        else:
            result = con.execute(oracle[name])
            columns = [c[0] for c in result.description]
            want = _canonical(result.fetchall(), columns)
            if sorted(columns) != sorted(df.columns):
                verdicts[name] = f"COLUMNS {sorted(df.columns)} <> {sorted(columns)}"
            elif got != want:
                only, missing = [r for r in got if r not in set(want)][:show], [r for r in want if r not in set(got)][:show]
                verdicts[name] = f"DIFFERENT {len(got)} / {len(want)} rows; spark only {only}; sql only {missing}"
            else:
                verdicts[name] = "ok"
        print(f"{name}: {verdicts[name]} rows={len(got)} {took:.1f}s", flush=True)
    return verdicts


if __name__ == "__main__":
    from pyspark.sql import SparkSession
    session = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "12g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    results = compare(session, sys.argv[1], sys.argv[2:] or None)
    bad = {k: v for k, v in results.items() if v not in ("ok", "rows only")}
    print(f"{len(results) - len(bad)} fine, {len(bad)} not: {sorted(bad)}")
