"""Long and wide layouts, registries, splitting by class of signal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.parse import glob_regex
from .query import ordering

MAX_COLUMNS = 5_000


def to_wide(df: DataFrame, index: Sequence[str], name: str, value: str, names: Sequence[str] | None = None, order: Sequence[str] = (), last: bool = True) -> DataFrame:
    """A row for each index, a column for each name, with the value that is not null of the largest (or
    least) order. names should be given: to collect them costs a job, and more than MAX_COLUMNS raise."""
    if names is None:
        names = [r[0] for r in df.select(name).where(F.col(name).isNotNull()).distinct().orderBy(name).limit(MAX_COLUMNS + 1).collect()]
    if len(names) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} columns")
    pick = F.max_by if last else F.min_by
    at = ordering(df, order or [value])
    own = lambda n: F.when((F.col(name) == n) & F.col(value).isNotNull(), at)
    return df.groupBy(*index).agg(*[pick(value, own(n)).alias(str(n)) for n in names])


def to_long(df: DataFrame, index: Sequence[str], cols: Sequence[str], name: str = "name", value: str = "value", keep_nulls: bool = False) -> DataFrame:
    """A row for each index and column."""
    out = df.unpivot([F.col(f"`{c}`") for c in index], [F.col(f"`{c}`") for c in cols], name, value)
    return out if keep_nulls else out.where(F.col(value).isNotNull())


def split_by_class(df: DataFrame, index: Sequence[str], rules: dict[str, Sequence[str]], rest: str) -> dict[str, DataFrame]:
    """Tables of the columns that each class's globs match first; others go to rest."""
    import re

    out: dict[str, list[str]] = {c: [] for c in [*rules, rest]}
    for c in df.columns:
        if c not in index:
            out[next((k for k, globs in rules.items() if any(re.match(glob_regex(g), c) for g in globs)), rest)].append(c)
    return {k: df.select(*index, *[F.col(f"`{c}`") for c in cols]) for k, cols in out.items()}


def merge_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Rows that share keys in one: of each column the value that is not null of the largest order."""
    at = ordering(df, order)
    return df.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in cols])


def point_registry(df: DataFrame, name: str) -> DataFrame:
    """(name, id): the distinct names in order with four-digit hexadecimal numbers from 0; more than
    65,536 raise when the result is read."""
    w = Window.orderBy(name)  # one task, over distinct names only
    rows = df.select(name).where(F.col(name).isNotNull()).distinct().withColumn("n", F.row_number().over(w) - 1)
    number = F.when(F.col("n") < 65_536, F.lower(F.lpad(F.hex("n"), 4, "0"))).otherwise(F.raise_error(F.lit("more than 65536 names")))
    return rows.select(name, number.alias("id"))


def topic_template(df: DataFrame, topic: str, site: str | None = None) -> DataFrame:
    """(reason, n, units, points): how many messages of ems/site/{site}/unit/{unit}/{device}/{instance}/
    {point}/{dtype} are kept or why they are skipped, with distinct units and points of each."""
    seg = F.split(F.col(topic), "/")
    at = lambda k: F.get(seg, F.lit(k))
    reason = F.when(~F.col(topic).startswith("ems/site/") | F.col(topic).isNull(), "prefix").when(F.size(seg) < 9, "short")
    reason = reason.when(at(3) != "unit", "no unit").when(at(5) == "root", "root")
    reason = reason.when(at(2) != site, "site") if site is not None else reason
    rows = df.select(reason.otherwise("kept").alias("reason"), at(4).alias("unit"), F.struct(at(5), at(6), at(7), at(8)).alias("point"))
    return rows.groupBy("reason").agg(F.count("*").alias("n"), F.countDistinct("unit").alias("units"), F.countDistinct("point").alias("points"))
