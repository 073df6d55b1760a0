"""One entry for a comparison stated as data: filters, view, fields; the result is a DataFrame.

A query is a mapping: filters (as filters.grouped takes them), filter_mode, view ("discover", "raw" or
"controlled"), outcome, compare, hold (fields), and preferences for discovery. Fields are found by the catalog's
profile, so whether a field counts as numeric depends on its values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators import compare as C
from larder.operators.filters import grouped

#: A preferred field's score is raised, a demoted one's lowered; coverage counts as this at least.
PREFERRED, DEMOTED, LEAST_COVERAGE = 1.25, 0.2, 0.2


class QueryError(ValueError):
    """A query that the records can't answer."""


def profile(df: DataFrame, fields: Sequence[str]) -> dict[str, bool]:
    """Fields with two values at least, and whether each is numeric: one row a field is collected."""
    rows = C.field_catalog(df, list(fields), categories=0).select("field", "numeric").collect()
    return {r["field"]: r["numeric"] for r in sorted(rows, key=lambda r: list(fields).index(r["field"]))}


def strength(df: DataFrame, outcome: str, field: str, numeric: bool) -> DataFrame:
    """One row: field, numeric, strength, used: |rho| + min(1, |slope|), or a hundred times the gap between groups' means."""
    if numeric:
        pairs = df.select(F.col(field).cast("double").alias("x"), F.col(outcome).cast("double").alias("y"))
        rho, line = C.spearman(pairs, "x", "y"), C.regression(pairs, "x", "y")
        both = rho.select("n", "rho").join(line.select("n", "slope"), "n")
        value = F.coalesce(F.abs("rho"), F.lit(0.0)) + F.least(F.lit(1.0), F.coalesce(F.abs("slope"), F.lit(0.0)))
        return both.select(F.lit(field).alias("field"), F.lit(True).alias("numeric"), value.alias("strength"), F.col("n").alias("used"))
    groups = C.grouped_raw(df, outcome, field)
    out = groups.agg(F.count("*").alias("g"), ((F.max("mean") - F.min("mean")) * 100).alias("strength"), F.sum("n").alias("used")).filter("g >= 2")
    return out.select(F.lit(field).alias("field"), F.lit(False).alias("numeric"), "strength", "used")


def discovery(df: DataFrame, outcome: str, fields: Mapping[str, bool], prefer: Sequence[str] = (), demote: Sequence[str] = (), exclude: Sequence[str] = (), most: int = 20) -> DataFrame:
    """field, numeric, coverage, score: fields by how much the outcome goes with them, times their coverage."""
    total = df.count()
    wanted = [f for f in fields if f != outcome and f.lower() not in {e.lower() for e in exclude}]
    if not wanted:
        raise QueryError("there is no field to compare with")
    rows = reduce(DataFrame.unionByName, (strength(df, outcome, f, fields[f]) for f in wanted))
    name, coverage = F.lower("field"), F.col("used") / F.lit(max(total, 1))
    score = F.col("strength") * F.greatest(F.lit(LEAST_COVERAGE), coverage)
    score = score * F.when(name.isin([p.lower() for p in prefer]), PREFERRED).otherwise(1.0)
    demoted = reduce(lambda a, b: a | b, (F.contains(name, F.lit(d.strip().lower())) for d in demote if d.strip()), F.lit(False))
    scored = rows.select("field", "numeric", coverage.alias("coverage"), (score * F.when(demoted, DEMOTED).otherwise(1.0)).alias("score"))
    return scored.orderBy(F.desc("score"), "field").limit(most)


def hold_suggestions(df: DataFrame, outcome: str, compared: str, fields: Mapping[str, bool], most: int = 8) -> DataFrame:
    """field, score: candidates to hold constant, by their strength with the outcome and with the compared field.

    The compared field counts as its average rank of outcome means where it isn't numeric.
    """
    key = C.grouped_raw(df, outcome, compared).select(F.col("grp").alias("_g"), F.col("mean").alias("_c"))
    coded = df if fields.get(compared) else df.join(key, C.comparable(F.col(compared)) == F.col("_g"), "left")
    target = compared if fields.get(compared) else "_c"
    total, rows = df.count(), []
    for f in fields:
        if f not in (outcome, compared):
            a = strength(df, outcome, f, fields[f]).select("field", F.col("strength").alias("a"), "used")
            b = strength(coded, target, f, fields[f]).select("field", F.col("strength").alias("b"))
            rows.append(a.join(b, "field"))
    if not rows:
        raise QueryError("there is no field to hold")
    every = reduce(DataFrame.unionByName, rows)
    score = (F.col("a") + F.col("b")) * F.greatest(F.lit(LEAST_COVERAGE), F.col("used") / F.lit(max(total, 1)))
    return every.select("field", score.alias("score")).orderBy(F.desc("score"), "field").limit(most)


def numeric_raw(df: DataFrame, outcome: str, compared: str, bins: int = 5) -> DataFrame:
    """One row: n, slope, intercept, r2, rho and bins (an array of n, low, high and mean)."""
    line, rho = C.regression(df, compared, outcome), C.spearman(df, compared, outcome)
    rows = C.equal_count_bins(df, compared, outcome, bins).agg(F.array_sort(F.collect_list(F.struct("bin", "n", "low", "high", "mean"))).alias("_b"))
    shown = F.transform("_b", lambda b: F.struct(b["n"].alias("n"), b["low"].alias("low"), b["high"].alias("high"), b["mean"].alias("mean")))
    return line.join(rho, "n").crossJoin(rows).withColumn("bins", shown).drop("_b")  # one row each


def numeric_controlled(df: DataFrame, outcome: str, compared: str, hold: Sequence[str]) -> DataFrame:
    """One row: n, slope, intercept, r2 and rho within strata, and how many rows and strata of all these rest on."""
    within = C.within_strata(df, outcome, compared, list(hold))
    known = df.filter(F.col(compared).isNotNull() & F.col(outcome).isNotNull())
    strata = F.count_distinct(F.struct(*(F.coalesce(F.col(h).cast("string"), F.lit("")) for h in hold)))
    total, used = known.agg(F.count("*").alias("rows"), strata.alias("strata")), within.agg(strata.alias("strata_used"))
    return C.regression(within, "x", "y").join(C.spearman(within, "x", "y"), "n").crossJoin(total).crossJoin(used)  # one row each


def analyze(df: DataFrame, query: Mapping, fields: Sequence[str]) -> DataFrame:
    """The view that a query asks for; discovery where it names no known field to compare."""
    kept = df.filter(grouped(query.get("filters", {}), query.get("filter_mode", "and")))
    known = profile(kept, fields)
    numeric = [f for f, n in known.items() if n]
    outcome = query.get("outcome") or (numeric[0] if numeric else "")
    if outcome not in numeric:
        raise QueryError(f"{outcome or 'no field'} is not numeric")
    compared, view, hold = query.get("compare") or "", query.get("view", "raw"), [h for h in query.get("hold", ()) if h in fields]
    if view == "discover" or compared not in known:
        p = query.get("preferences", {})
        return discovery(kept, outcome, known, p.get("prefer", ()), p.get("demote", ()), p.get("exclude", ()), p.get("most", 20))
    if known[compared]:
        if view == "controlled" and hold:
            return numeric_controlled(kept, outcome, compared, hold)
        return numeric_raw(kept, outcome, compared)
    if view == "controlled":
        return C.grouped_controlled(kept, outcome, compared, hold)
    return C.grouped_raw(kept, outcome, compared)


def weak_coverage(total_rows: int, used_rows: int, total_strata: int, used_strata: int) -> list[str]:
    """Warnings on comparisons that rest on little."""
    out = []
    if total_rows and used_rows / total_rows < 0.6:
        out.append("under 60 % of the rows are compared")
    if total_strata and used_strata / total_strata < 0.6:
        out.append("under 60 % of the strata hold several groups")
    if used_rows < 20:
        out.append("under 20 rows are compared")
    if total_strata and used_strata < 3:
        out.append("under 3 strata are compared")
    return out
