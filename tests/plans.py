"""Helpers to look at the physical plan of a DataFrame."""

import re
from contextlib import contextmanager


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(df, operator):
    return len(re.findall(rf"\b{operator}\b", physical(df)))


def without_broadcast(spark):
    return settings(spark, spark__sql__autoBroadcastJoinThreshold=-1)
