import glob
from contextlib import contextmanager


@contextmanager
def conf(spark, **settings):
    """Session settings for the length of a block."""
    settings = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def files(path, pattern="*.parquet"):
    return sorted(glob.glob(f"{path.removeprefix('file:')}/**/{pattern}", recursive=True))


def plan(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
