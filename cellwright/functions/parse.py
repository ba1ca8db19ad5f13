"""Topics and payloads as column expressions: no Python runs on rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .time import epoch_time, iso_time

__all__ = [
    "classify_payload", "coerce", "compound", "flat_fields", "glob_regex", "json_value", "parse_payload", "select_topics", "split_value",
    "topic_kv", "topic_patterns", "topic_positional", "topic_regex", "unmatched_topics", "value_of",
]

_INT = r"^-?\d{1,18}$"


def topic_kv(topic: Column) -> dict[str, Column]:
    """source_type, ints (map of the k=v segments whose v is an integer; of repeated keys the last) and
    field_name (the last segment without "=") of a topic like src/a=1/b=2/field. A null or empty topic
    has null source_type and field_name and no ints."""
    pairs = r"/([^/=]+)=(-?\d{1,18})(?=/|\z)"
    names, values = (F.regexp_extract_all(topic, F.lit(pairs), F.lit(k)) for k in (1, 2))
    # the last bare segment: what comes after it are pairs and empty ones
    field = F.regexp_extract(topic, r"/([^/=]+)(?:/(?:[^/]*=[^/]*)?)*\z", 1)
    # of a repeated key the last: entries that a later one repeats are left out
    last = F.filter(F.arrays_zip(names.alias("k"), values.cast("array<bigint>").alias("v")), lambda e, i: F.array_position(F.reverse(names), e["k"]) == F.size(names) - i)
    ints = F.when(F.size(F.array_distinct(names)) == F.size(names), F.map_from_arrays(names, values.cast("array<bigint>"))).otherwise(F.map_from_entries(last))
    return {
        "source_type": F.when(topic != "", F.substring_index(topic, "/", 1)),
        "ints": F.when(topic.isNotNull(), ints),
        "field_name": F.when(field != "", field),
    }


def topic_positional(topic: Column, segments: Sequence[str]) -> dict[str, Column]:
    """A column for each named segment by its place; "_" skips one. Places beyond a short topic are null."""
    parts = F.split(topic, "/")
    return {name: F.get(parts, F.lit(k)) for k, name in enumerate(segments) if name != "_"}


def topic_regex(pattern: str) -> str:
    """Regular expression of a topic filter: + is one segment, # at the end any number of them."""
    out = []
    parts = pattern.split("/")
    for k, part in enumerate(parts):
        if part == "#" and k == len(parts) - 1:
            return "^" + "/".join(out) + ("(/.*)?$" if out else ".*$")
        out.append("[^/]*" if part == "+" else re.escape(part))
    return "^" + "/".join(out) + "$"


def topic_patterns(df: DataFrame, topic: str, patterns: Sequence[dict]) -> DataFrame:
    """Add a column for every segment name that patterns have, and pattern, the one that matched first.

    A pattern is {"match": filter, "segments": names, "reverse": aligned from the right?}. Rows that
    match none keep nulls."""
    names = list(dict.fromkeys(n for p in patterns for n in p["segments"] if n != "_"))
    out = {n: F.lit(None).cast("string") for n in names}
    which = F.lit(None).cast("string")
    parts = F.split(F.col(topic), "/")
    for p in reversed(patterns):
        fits = F.col(topic).rlike(topic_regex(p["match"]))
        which = F.when(fits, p["match"]).otherwise(which)
        seg = list(p["segments"])
        at = {n: (F.get(parts, F.size(parts) - len(seg) + k) if p.get("reverse") else F.get(parts, F.lit(k))) for k, n in enumerate(seg) if n != "_"}
        out = {n: F.when(fits, at.get(n, F.lit(None).cast("string"))).otherwise(c) for n, c in out.items()}
    return df.withColumns(out | {"pattern": which})


def unmatched_topics(df: DataFrame, topic: str, patterns: Sequence[str]) -> DataFrame:
    """(depth, prefix, example, n): topics that no filter matches, by number and first of their segments."""
    known = F.lit(False)
    for p in patterns:
        known = known | F.col(topic).rlike(topic_regex(p))
    left = df.where(F.col(topic).isNotNull() & ~known)
    parts = F.split(F.col(topic), "/")
    return left.groupBy(F.size(parts).alias("depth"), F.get(parts, F.lit(0)).alias("prefix")).agg(F.min(topic).alias("example"), F.count("*").alias("n"))


def topic_chosen(topic: str, groups: dict[str, Sequence[str]], chosen: Sequence[str]) -> Column:
    """Whether a filter of one of the chosen groups matches a topic; of no groups, never."""
    fits = F.lit(False)
    for p in dict.fromkeys(p for g in chosen for p in groups[g]):
        fits = fits | F.col(topic).rlike(topic_regex(p))
    return fits


def select_topics(df: DataFrame, topic: str, groups: dict[str, Sequence[str]], chosen: Sequence[str]) -> DataFrame:
    """Rows whose topic is chosen."""
    return df.where(topic_chosen(topic, groups, chosen))


def json_value(payload: Column, field: str) -> Column:
    """A field's value as text, of an object {"value": ..., "unit": ...} its value; an object without
    value gives null, and so does malformed JSON."""
    plain = F.get_json_object(payload, f"$.{field}")
    return F.coalesce(F.get_json_object(payload, f"$.{field}.value"), F.when(~plain.startswith("{"), plain))


def flat_fields(payload: Column) -> dict[str, Column]:
    """floats: the fields whose values are numbers; strings: those whose values are other scalars. Nested
    objects count with their value. Null maps for malformed JSON."""
    raw = F.from_json(payload, "map<string,string>")
    flat = F.transform_values(raw, lambda _, v: F.when(v.startswith("{"), F.get_json_object(v, "$.value")).otherwise(v))
    number = lambda v: v.try_cast("double")
    floats = F.transform_values(F.map_filter(flat, lambda _, v: number(v).isNotNull()), lambda _, v: number(v))
    return {"floats": floats, "strings": F.map_filter(flat, lambda _, v: number(v).isNull() & v.isNotNull())}


def parse_payload(df: DataFrame, payload: str, fields: dict[str, str], ts_field: str = "ts", ts_format: str = "iso", on_bad: str = "keep") -> DataFrame:
    """Add ts and a column of the given type for each field of a JSON payload.

    A value that cannot be cast is null. Rows with malformed JSON keep their other columns, with nulls
    here (on_bad="keep"), or are left out ("drop")."""
    raw = json_value(F.col(payload), ts_field)
    time = iso_time(raw) if ts_format == "iso" else epoch_time(raw)
    out = df.withColumns({"ts": time, **{f: json_value(F.col(payload), f).try_cast(kind) for f, kind in fields.items()}})
    if on_bad == "drop":
        return out.where(F.try_parse_json(F.col(payload)).isNotNull())
    if on_bad != "keep":
        raise ValueError("on_bad is 'keep' or 'drop'")
    return out


def coerce(df: DataFrame, ints: Sequence[str], floats: Sequence[str]) -> DataFrame:
    """Cast the named columns that df has; what cannot be cast is null, but a missing project_id is 0."""
    out = {c: F.col(c).try_cast("long") for c in ints if c in df.columns} | {c: F.col(c).try_cast("double") for c in floats if c in df.columns}
    out["project_id"] = F.coalesce(out.get("project_id", F.lit(None).cast("long")), F.lit(0).cast("long"))
    return df.withColumns(out)


def split_value(value: Column, dtype: Column) -> dict[str, Column]:
    """value_i for integers and booleans kept as such, value_f for other numbers, value_str for strings."""
    whole = dtype.isin("integer", "boolean_integer", "int", "boolean")
    return {
        "value_i": F.when(whole, value.try_cast("double").cast("long")),
        "value_f": F.when(~whole & (dtype != "string"), value.try_cast("double")),
        "value_str": F.when(dtype == "string", value),
    }


def value_of(value_f: str = "value_f", value_i: str = "value_i") -> dict[str, Column]:
    """One number of the two, and which it was."""
    return {"value": F.coalesce(F.col(value_f), F.col(value_i).cast("double")), "dtype": F.when(F.col(value_f).isNotNull(), "float").when(F.col(value_i).isNotNull(), "integer")}


def compound(df: DataFrame, parts: Sequence[str], name: str = "point_name") -> DataFrame:
    """Join columns with "/" into name and drop them; nulls are left out."""
    return df.withColumn("_compound", F.concat_ws("/", *parts)).drop(*[p for p in parts if p != name]).drop(name).withColumnRenamed("_compound", name)


def glob_regex(glob: str) -> str:
    return "^" + "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in glob) + "$"


def classify_payload(payload: Column, ids: Sequence[str]) -> dict[str, Column]:
    """layout: nested if some value is an object with a value, flat if all are scalars, else unknown;
    identified: whether one of the ids is there."""
    raw = F.from_json(payload, "map<string,string>")
    values = F.map_values(raw)
    nested = F.exists(values, lambda v: v.startswith("{") & F.get_json_object(v, "$.value").isNotNull())
    flat = (F.size(raw) > 0) & F.forall(values, lambda v: ~(v.startswith("{") | v.startswith("[")))
    has = F.arrays_overlap(F.map_keys(raw), F.array(*[F.lit(i) for i in ids]))
    return {"layout": F.when(nested, "nested").when(flat, "flat").otherwise("unknown"), "identified": F.coalesce(has, F.lit(False))}
