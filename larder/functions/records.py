"""Fields of nested records by path, the list of all of them, and what a run's settings say about it."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from larder.functions.fields import EMPTY, first_set, maybe_number, path_text, settings_map

#: Structures are looked into down to this depth.
DEPTH = 4


def paths_of(schema: StructType, derived: Sequence[str] = (), preferred: Sequence[str] = (), depth: int = DEPTH) -> list[str]:
    """Dotted paths of a schema's leaves (arrays, maps and what lies deeper are leaves) and derived names: preferred ones first, then alphabetically."""

    def walk(kind: DataType, prefix: str, level: int) -> list[str]:
        if not isinstance(kind, StructType) or level > depth or not kind.fields:
            return [prefix] if prefix else []
        return [p for f in kind.fields for p in walk(f.dataType, f"{prefix}.{f.name}" if prefix else f.name, level + 1)]

    found = {*walk(schema, "", 0), *derived}
    first = [p for p in dict.fromkeys(preferred) if p in found]
    return first + sorted(found - set(first))


def value_at(schema: StructType, path: str, derived: Mapping[str, Column] | None = None) -> Column:
    """The column at a dotted path, or a derived one; nested values as JSON with sorted keys; null where the schema has no such path.

    Map keys may be part of a path.
    """
    path = path.strip()
    if derived and path in derived:
        return derived[path]
    at, kind = None, schema
    for key in path.split(".") if path else []:
        if isinstance(kind, StructType) and key in kind.names:
            at = F.col(f"`{key}`") if at is None else at.getField(key)
            kind = kind[key].dataType
        elif isinstance(kind, MapType) and at is not None:
            at, kind = F.element_at(at, F.lit(key)), kind.valueType
        else:
            return F.lit(None).cast("string")
    if at is None:
        return F.lit(None).cast("string")
    return F.to_json(sorted_keys(at, kind)) if isinstance(kind, StructType | ArrayType | MapType) else at


def sorted_keys(x: Column, kind: DataType) -> Column:
    """x with the keys of its structures, also those inside arrays, in alphabetical order."""
    if isinstance(kind, StructType):
        return F.when(x.isNotNull(), F.struct(*(sorted_keys(x.getField(n), kind[n].dataType).alias(n) for n in sorted(kind.names))))
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType | ArrayType):
        return F.transform(x, lambda e: sorted_keys(e, kind.elementType))
    return x


def setting(config: Column, summary: Column, *keys: str) -> Column:
    """The first of these settings that isn't blank or a word for none: in the map, else in the summary text."""
    parsed = settings_map(summary)
    return F.coalesce(first_set(*(F.element_at(config, F.lit(k)) for k in keys)), first_set(*(F.element_at(parsed, F.lit(k)) for k in keys)))


def normal_name(x: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(x)), "[- ]", "_")


def assistance(explicit: Column, surfaces: Mapping[str, Column], profiles: Mapping[frozenset, str], model: Column, known: Sequence[str], full: str, other: str = "other", off: str = "off") -> Column:
    """The profile of a run: an explicit known one; else by which surfaces are on; else the full one where a model is named.

    surfaces: name to its pipeline setting (null: not stated; `off`: off). profiles: sets of surfaces that are on to a profile.
    """
    name = normal_name(explicit)
    stated = reduce(lambda a, b: a | b, (s.isNotNull() for s in surfaces.values()))
    on = {n: F.coalesce(F.lower(s) != off, F.lit(False)) for n, s in surfaces.items()}
    by_surface = F.lit(None).cast("string")
    for names, profile in profiles.items():
        exactly = reduce(lambda a, b: a & b, (c if n in names else ~c for n, c in on.items()))
        by_surface = F.when(exactly, profile).otherwise(by_surface)
    return F.coalesce(F.when(name.isin(*known), name), F.when(stated, by_surface), F.when(model.isNotNull(), full), F.lit(other))


def variant(explicit: Column, names: Mapping[str, str], profile: Column) -> Column:
    """An explicit variant by its canonical name, else the profile."""
    table = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    return F.coalesce(F.element_at(table, normal_name(explicit)), profile)


def is_official(path: Column, folders: Sequence[str], variant_of: Column, profile: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Whether a path has all folders, and variant and profile are one of the allowed pairs."""
    p = path_text(path)
    inside = reduce(lambda a, b: a & b, (F.contains(p, F.lit(f"/{f}/")) for f in folders))
    return inside & reduce(lambda a, b: a | b, ((variant_of == v) & (profile == q) for v, q in pairs))


def secondary_metrics(df: DataFrame, fields: Sequence[str], preferred: Sequence[str], pattern: str, without: Sequence[str], most: int = 4) -> DataFrame:
    """field, n, low, high, place: up to `most` fields, preferred ones first, then others that match the pattern, with two numbers at least that differ."""
    wanted = [f for f in dict.fromkeys([*preferred, *fields]) if f in fields and f not in without and (f in preferred or re.search(pattern, f))]
    if not wanted:
        return df.sparkSession.createDataFrame([], "field string, n long, low double, high double, place int")
    value = {f: maybe_number(F.col(f)) for f in wanted}
    sums = df.agg(*(x for i, f in enumerate(wanted) for x in (F.count(value[f]).alias(f"n{i}"), F.min(value[f]).alias(f"l{i}"), F.max(value[f]).alias(f"h{i}"))))
    rows = sums.select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"n{i}").alias("n"), (F.col(f"l{i}") + 0.0).alias("low"), (F.col(f"h{i}") + 0.0).alias("high"), F.lit(i).alias("place")) for i, f in enumerate(wanted)))).alias("r")).select("r.*")
    return rows.filter((F.col("n") >= 2) & (F.col("high") - F.col("low") > 1e-12)).orderBy("place").limit(most)


class NoGroups(ValueError):
    """A subset without a field or without a group."""


def subset_filter(field: str, groups: Sequence[str]) -> dict[str, dict]:
    """A filter, as filters.grouped takes it, for the rows of some of a field's groups; the empty group can't be asked for."""
    wanted = [g for g in dict.fromkeys(str(g).strip() for g in groups) if g and g != EMPTY]
    if not field.strip() or not wanted:
        raise NoGroups("name a field and one of its groups")
    return {field.strip(): {"mode": "or", "clauses": [{"operator": "eq", "value": g} for g in wanted]}}
