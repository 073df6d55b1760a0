"""Column expressions over run records: lenient casts, keys for grouping, paths, derived metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY = "__EMPTY__"
NUMERIC = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that each row works out once, however often body uses it; a plain column would be copied to each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(x: Column) -> Column:
    return x.cast("string")


def basename(path: Column) -> Column:
    """Last component of a path with either separator; null where it's blank."""
    p = F.rtrim(F.replace(F.trim(path), F.lit("\\"), F.lit("/")), F.lit("/"))
    return F.nullif(F.element_at(F.split(p, "/"), -1), F.lit(""))


def maybe_number(x: Column) -> Column:
    """A finite number from lenient text, else null; booleans count as 1 and 0."""
    t = F.trim(text_of(x))
    value = F.when(F.typeof(x) == "boolean", F.when(t == "true", 1.0).when(t == "false", 0.0)).otherwise(F.when(t.rlike(NUMERIC), t).try_cast("double"))
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def number_of_boolean(x: Column) -> Column:
    return F.when(x, 1.0).when(~x, 0.0)


def rule_value(x: Column) -> Column:
    """What text rules compare: lower case, trimmed, empty for null."""
    return F.lower(F.trim(F.coalesce(text_of(x), F.lit(""))))


def is_blank(x: Column) -> Column:
    return x.isNull() | (F.trim(text_of(x)) == "")


def comparable(x: Column) -> Column:
    """The grouping key of a value; numbers that aren't finite count as empty."""
    number = F.typeof(x).isin("double", "float")
    text = F.nullif(F.trim(text_of(x)), F.lit(""))
    return F.coalesce(F.when(~(number & F.lower(text).isin("nan", "infinity", "-infinity")), text), F.lit(EMPTY))


def displayed(x: Column) -> Column:
    """Numbers: without decimals where whole, else with four."""
    return F.when(x == F.floor(x), F.format_string("%d", x.cast("long"))).otherwise(F.format_string("%.4f", x))


def effective_tokens(given: Column, cached: Column, output: Column, total: Column) -> Column:
    """Tokens with the cached part of the input at a tenth; the plain total where no part is known."""
    none = given.isNull() & cached.isNull() & output.isNull()
    zero = F.lit(0.0)
    fresh = F.greatest(zero, F.coalesce(given, zero) - F.coalesce(cached, zero))
    return F.when(none, total).otherwise(fresh + F.lit(0.1) * F.coalesce(cached, zero) + F.coalesce(output, zero))


def per_item(metric: Column, items: Column) -> Column:
    return F.when(items > 0, metric / items)


def epoch_seconds(x: Column) -> Column:
    """Seconds of 'YYYY-MM-DD_HH.MM.SS' or an ISO timestamp; null where it can't be read."""
    t = F.regexp_replace(F.trim(x), r"^(\d{4}-\d{2}-\d{2})_(\d{2})\.(\d{2})\.(\d{2})$", "$1 $2:$3:$4")
    return F.unix_micros(F.try_to_timestamp(t)) / F.lit(1e6)


def settings_map(summary: Column) -> Column:
    """'k=v | k=v' as a map of trimmed texts; parts without a key are dropped."""
    parts = F.filter(F.split(F.coalesce(summary, F.lit("")), r"\|"), lambda p: F.instr(F.trim(p), "=") > 1)
    pairs = F.transform(parts, lambda p: F.struct(F.trim(F.substring_index(p, "=", 1)), F.trim(F.substring(p, F.instr(p, "=") + 1, F.length(p)))))
    return F.map_from_entries(F.array_distinct(pairs))


def first_set(*values: Column) -> Column:
    """The first value that isn't blank or a word for none."""
    return F.coalesce(*(F.when(~F.lower(F.trim(v)).isin("", "none", "null", "n/a", "default"), F.trim(v)) for v in values))


def dominant(parts: dict[str, Column], total: Column, least: float = 0.5) -> Column:
    """The name of the largest part where it makes up at least this share of the total."""
    best = F.array_max(F.array(*(F.struct(F.coalesce(v, F.lit(0.0)).alias("v"), F.lit(-i).alias("i"), F.lit(k).alias("k")) for i, (k, v) in enumerate(parts.items()))))
    return F.when((total > 0) & (best["v"] / total >= least), best["k"])


def sum_or_null(*values: Column) -> Column:
    """The sum of what is known; null only if nothing is."""
    total = sum((F.coalesce(v, F.lit(0)) for v in values[1:]), F.coalesce(values[0], F.lit(0)))
    return F.when(F.coalesce(*values).isNotNull(), total)


def path_text(path: Column) -> Column:
    """A path in lower case with forward slashes; empty for null."""
    return F.lower(F.replace(F.coalesce(path, F.lit("")), F.lit("\\"), F.lit("/")))


#: Words that mark a timestamped run folder as a trial.
TRIAL_WORDS = ("manual", "smoke", "test", "debug", "quick", "probe", "sample", "trial")


def is_trial_path(path: Column) -> Column:
    """Whether a run's path is that of a bench folder, a test's temporary folder, or a timestamped folder named as a trial."""
    p = path_text(path)
    stamp = r"\d{4}-\d{2}-\d{2}[t_]\d{2}[.:]\d{2}[.:]\d{2}"
    trial = rf"(^|/){stamp}_([^/]*[-_])?({'|'.join(TRIAL_WORDS)})([-_][^/]*)?(/|$)"
    return F.contains(p, F.lit("/bench/")) | p.rlike(r"(^|/)pytest-\d+(/|$)") | p.rlike(r"(^|/)test_[^/]+(/|$)") | p.rlike(trial)


def has_folder(path: Column, folder: str) -> Column:
    return F.contains(path_text(path), F.lit(f"/{folder.strip('/').lower()}/"))


def token_after(path: Column, marker: str, useless: tuple[str, ...] = ("", "runs", "output")) -> Column:
    """The folder after a marker folder, unless it says nothing."""
    parts = F.split(path_text(path), "/")
    at = F.array_position(parts, marker.lower()).cast("int")
    return F.when(at > 0, F.nullif(F.when(F.get(parts, at).isin(*useless), "").otherwise(F.get(parts, at)), F.lit("")))


def with_missing(base: Column, more: Column, runtime: tuple[str, ...] = ()) -> Column:
    """A map with another's keys added where absent; runtime keys are replaced too where their value is a word for none."""
    none = lambda v: F.lower(F.trim(F.coalesce(v, F.lit("")))).isin("", "none", "null", "n/a", "default")
    kept = F.map_filter(base, lambda k, v: ~(k.isin(*runtime) & none(v))) if runtime else base
    return F.map_concat(kept, F.map_filter(more, lambda k, v: ~F.array_contains(F.map_keys(kept), k)))


def cascade(*cases: tuple[Column, Column | str], other: str = "-") -> Column:
    """The first case that holds; null conditions don't."""
    out = F.lit(other)
    for when, value in reversed(cases):
        out = F.when(F.coalesce(when, F.lit(False)), value if isinstance(value, Column) else F.lit(value)).otherwise(out)
    return out
