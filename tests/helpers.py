import glob
import os

import duckdb


def norm(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "tzinfo") and v.tzinfo:
        return v.replace(tzinfo=None)
    return v


def by_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(norm(v) for v in r) for r in df.select(*cols).collect()), key=repr)


def by_duckdb(sf_dir, query):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    got = con.execute(query)
    names = [x[0] for x in got.description]
    order = [names.index(c) for c in sorted(names)]
    return sorted(names), sorted((tuple(norm(r[i]) for i in order) for r in got.fetchall()), key=repr)
