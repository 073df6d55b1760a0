"""Files of records: dispatch by format, JSON lines, history tables, and their sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Registry:
    """Readers by name, each with an expression of how sure it is of a path; the first registered wins ties."""

    scores: dict[str, Callable[[Column], Column]] = field(default_factory=dict)

    def register(self, name: str, score: Callable[[Column], Column]) -> None:
        if name in self.scores:
            raise ValueError(f"{name} is registered already")
        self.scores[name] = score

    def best(self, path: Column) -> Column:
        """The reader's name; null where no score is over 0."""
        options = [F.struct(F.coalesce(f(path), F.lit(0.0)).alias("s"), F.lit(-i).alias("i"), F.lit(n).alias("n")) for i, (n, f) in enumerate(self.scores.items())]
        top = F.array_max(F.array(*options))
        return F.when(top["s"] > 0, top["n"])


def by_suffix(*suffixes: str, score: float = 0.9) -> Callable[[Column], Column]:
    return lambda path: F.when(F.lower(path).rlike(r"\.(" + "|".join(suffixes) + ")$"), F.lit(score)).otherwise(F.lit(0.0))


def default_registry() -> Registry:
    r = Registry()
    for name, suffixes in {"text": ("txt", "md"), "html": ("html?", "jsonld"), "table": ("csv", "xlsx?"), "book": ("epub",), "pages": ("pdf",)}.items():
        r.register(name, by_suffix(*suffixes))
    return r


def files(spark: SparkSession, root: str) -> DataFrame:
    """path, size, changed of all files below a folder, without their content."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("changed"))


def read_lines(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """JSON lines of a schema; strict: any other line is an error, else it's skipped."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def write_lines(df: DataFrame, path: str) -> None:
    """JSON lines with sorted keys; nulls are left out. The write is committed as a whole."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def with_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns as text: missing ones empty, others dropped."""
    return df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns))


_CSV = {"header": "true", "quote": '"', "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def append_history(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Adds rows; cells may hold quotes and line breaks."""
    with_columns(df, columns).write.mode("append").options(**_CSV).option("quoteAll", "true").csv(path)


def read_history(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).options(**_CSV).option("multiLine", "true").csv(path)


def backfilled(history: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """The history with blank cells taken from another table's row of the same key."""
    names = {c: f"_m_{c}" for c in more.columns if c != key}
    joined = history.join(more.dropDuplicates([key]).withColumnsRenamed(names), key, "left")
    return joined.select(*(F.coalesce(F.nullif(F.trim(F.col(c)), F.lit("")), F.col(names[c])).alias(c) if c in names else F.col(c) for c in history.columns))


def ranges(df: DataFrame, rows: str, label: str, source: str) -> DataFrame:
    """df with start and end of the touched rows; without label, source or rows a record is skipped."""
    known = df.filter(F.col(label).isNotNull() & F.col(source).isNotNull() & (F.size(rows) > 0))
    return known.withColumns({"start": F.array_min(rows), "end": F.array_max(rows)})


def mapped_json(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """df with a text column for each (name: JSON path)."""
    return df.withColumns({n: F.get_json_object(column, p) for n, p in mapping.items()})
