"""Reports that runs leave as JSON files, predicted ranges of labelling tasks, mapping files, and sinks of stages."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.fields import epoch_seconds

STAMP = r"(\d{4}-\d{2}-\d{2}[T_]\d{2}[.:]\d{2}[.:]\d{2})"


def json_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """path, folder, run (the timestamped folder above, null for none), body: whole JSON files below a folder; hidden folders are passed over."""
    found = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(root, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    run = F.nullif(F.regexp_extract("path", rf"/{STAMP}[^/]*/", 1), F.lit(""))
    return found.filter(~F.col("path").rlike(r"/\.[^/]+/")).select("path", folder.alias("folder"), run.alias("run"), "body")


def parsed(files: DataFrame, fields: Mapping[str, Sequence[str]]) -> tuple[DataFrame, DataFrame]:
    """path, folder, run and a text column for each field (the first JSON path that gives anything), of files that are JSON objects; and the paths of those that aren't."""
    kind = F.try_parse_json("body")
    good = files.filter(kind.isNotNull() & F.trim("body").startswith("{"))
    bad = files.filter(kind.isNull() | ~F.trim("body").startswith("{")).select("path")
    return good.select("path", "folder", "run", *(F.coalesce(*(F.get_json_object("body", p) for p in paths)).alias(n) for n, paths in fields.items())), bad


#: Where an import report holds what a run's row has.
STAGE_FIELDS = {
    "source": ("$.sourceFile", "$.source_file"), "recipes": ("$.totalRecipes", "$.total_recipes"), "total_seconds": ("$.timing.total_seconds", "$.timing.totalSeconds"),
    "parsing_seconds": ("$.timing.parsing_seconds", "$.timing.parsingSeconds"), "writing_seconds": ("$.timing.writing_seconds", "$.timing.writingSeconds"), "units": ("$.totalUnits", "$.total_units"),
}


def stage_reports(spark: SparkSession, root: str, pattern: str = "*report.json", since: float | None = None) -> tuple[DataFrame, DataFrame]:
    """path, run, file, recipes, seconds of each step and seconds a recipe, of reports in timestamped run folders (since a moment, in seconds); and the paths of files that can't be read."""
    rows, bad = parsed(json_files(spark, root, pattern), STAGE_FIELDS)
    name = F.coalesce(F.nullif(F.regexp_extract("source", r"([^/\\]+)$", 1), F.lit("")), F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*report)?\.json$", 1))
    out = rows.filter("run IS NOT NULL").withColumn("file", name)
    number = {c: F.col(c).try_cast("double").alias(c) for c in ("recipes", "total_seconds", "parsing_seconds", "writing_seconds", "units")}
    out = out.select("path", "run", epoch_seconds(F.col("run")).alias("time"), "file", *number.values())
    out = out.withColumn("seconds_per_recipe", F.when(F.col("recipes") > 0, F.col("total_seconds") / F.col("recipes")))
    return (out if since is None else out.filter(F.col("time") >= since)), bad


EVAL_FIELDS = {"precision": ("$.precision",), "recall": ("$.recall",), "f1": ("$.f1",), "accuracy": ("$.overall_line_accuracy", "$.strict_accuracy"), "macro_f1": ("$.macro_f1_excluding_other",), "gold": ("$.counts.gold_total",), "matched": ("$.counts.gold_matched",)}


def evaluation_reports(spark: SparkSession, root: str, report: str = "eval_report.json", coverage: str = "coverage.json", manifest: str = "manifest.json") -> DataFrame:
    """folder, run, the scores of each evaluation report, and from files beside it covered and total characters, source and settings (JSON)."""
    scores, _ = parsed(json_files(spark, root, report), EVAL_FIELDS)
    chars, _ = parsed(json_files(spark, root, coverage), {"total_chars": ("$.extracted_chars",), "covered_chars": ("$.chunked_chars",)})
    made, _ = parsed(json_files(spark, root, manifest), {"source": ("$.source.path", "$.source_file"), "settings": ("$.run_config",)})
    out = scores.drop("path").join(chars.drop("path", "run"), "folder", "left").join(made.drop("path", "run"), "folder", "left")
    numbers = [*EVAL_FIELDS, "total_chars", "covered_chars"]
    return out.select("folder", "run", *(F.col(c).try_cast("double").alias(c) for c in numbers), "source", "settings")


def histories(spark: SparkSession, paths: Iterable[str], columns: Sequence[str], key: str, read: Callable[[SparkSession, str, Sequence[str]], DataFrame]) -> DataFrame:
    """One row a key: each column's first value that isn't blank, by the order of the histories."""
    rows = None
    for i, path in enumerate(paths):
        one = read(spark, path, columns).withColumn("_i", F.lit(i))
        rows = one if rows is None else rows.unionByName(one)
    value = lambda c: F.min_by(F.col(c), F.when(F.trim(F.coalesce(c, F.lit(""))) != "", F.col("_i"))).alias(c)
    return rows.filter(F.trim(F.coalesce(key, F.lit(""))) != "").groupBy(key).agg(*(value(c) for c in columns if c != key)).select(*columns)


#: Names of chunks that give a label, in order; patterns over type and hint.
CHUNK_LABELS = (
    ("INGREDIENT_LINE", r"ingredient"), ("INSTRUCTION_LINE", r"^step(?:_line)?$|_step$|list_item"), ("RECIPE_NOTES", r"^note$"), ("RECIPE_VARIANT", r"variant"),
    ("KNOWLEDGE", r"tip|knowledge|advice"), ("YIELD_LINE", r"yield|serving"), ("TIME_LINE", r"^(?:time_line|prep_time|cook_time|total_time)$|^time.*line"),
)


def chunk_label(level: Column, kind: Column, hint: Column, titles_known: Column) -> Column:
    """The label of a predicted chunk: titles from structural ones (whole recipes only where no titles are known), lines from atomic ones, OTHER for the rest; null for others."""
    k, h = F.coalesce(kind, F.lit("")), F.coalesce(hint, F.lit(""))
    title = F.when((k == "recipe_title") | (h == "recipe_title"), "RECIPE_TITLE").when(((k == "recipe_block") | (h == "recipe")) & ~titles_known, "RECIPE_TITLE")
    atomic = F.lit("OTHER")
    for label, pattern in reversed(CHUNK_LABELS):
        atomic = F.when(k.rlike(pattern) | h.rlike(pattern), label).otherwise(atomic)
    return F.when(level == "structural", title).when(level == "atomic", atomic)


def predicted_ranges(tasks: DataFrame) -> DataFrame:
    """id, source, file, label, start, end of labelling tasks (rows of one JSON text, `value`); those without id, label or place are left out. A place is in rows, else blocks, else lines, whichever is given first."""
    at = lambda p: F.get_json_object("value", f"$.data.{p}")
    rows = tasks.select(at("chunk_id").alias("id"), at("chunk_level").alias("level"), at("chunk_type").alias("kind"), at("chunk_type_hint").alias("hint"), at("source_hash").alias("source"), at("source_file").alias("file"), *(F.struct(at(f"location.{a}").try_cast("long").alias("a"), at(f"location.{b}").try_cast("long").alias("b")).alias(f"_{i}") for i, (a, b) in enumerate((("start_row", "end_row"), ("row_index", "row_index"), ("start_block", "end_block"), ("start_line", "end_line"), ("block_index", "block_index")))))
    known = rows.agg(F.coalesce(F.max((F.col("level") == "structural") & (F.col("kind") == "recipe_title")), F.lit(False)).alias("_known"))
    place = F.coalesce(*(F.when(F.col(f"_{i}.a").isNotNull() & F.col(f"_{i}.b").isNotNull(), F.col(f"_{i}")) for i in range(5)))
    out = rows.crossJoin(F.broadcast(known)).withColumn("label", chunk_label(F.col("level"), F.col("kind"), F.col("hint"), F.col("_known"))).withColumn("_p", place)  # one row is broadcast
    source = F.coalesce("source", F.when(F.size(F.split("id", ":")) >= 6, F.get(F.split("id", ":"), 4)))
    return out.filter("id IS NOT NULL AND id <> '' AND label IS NOT NULL AND _p IS NOT NULL").select("id", source.alias("source"), F.coalesce("file", F.lit("unknown")).alias("file"), "label", F.least("_p.a", "_p.b").alias("start"), F.greatest("_p.a", "_p.b").alias("end"))


def annotations(exported: DataFrame) -> DataFrame:
    """task, span, label, start, end, text of exported labelling results (rows of one JSON text, `value`), one row a label of a span; cancelled annotations are left out."""
    shape = "struct<id:string,annotations:array<struct<was_cancelled:boolean,result:array<struct<id:string,value:struct<start:int,end:int,text:string,labels:array<string>>>>>>>"
    parsed_ = exported.select(F.from_json("value", shape).alias("t")).filter("t IS NOT NULL")
    kept = F.flatten(F.transform(F.filter("t.annotations", lambda a: ~F.coalesce(a["was_cancelled"], F.lit(False))), lambda a: F.coalesce(a["result"], F.array().cast("array<struct<id:string,value:struct<start:int,end:int,text:string,labels:array<string>>>>"))))
    spans = parsed_.select(F.col("t.id").alias("task"), F.explode(kept).alias("r"))
    return spans.select("task", F.col("r.id").alias("span"), F.explode("r.value.labels").alias("label"), F.col("r.value.start").alias("start"), F.col("r.value.end").alias("end"), F.col("r.value.text").alias("text"))


@dataclass(frozen=True)
class SourceMapping:
    """How one source is to be read: sheets to take (all, if none are named), rows to skip, delimiters of lists, and further header names of fields."""

    sheets: tuple[str, ...] = ()
    skip_rows: int = 0
    delimiters: Mapping[str, str] = field(default_factory=dict)
    aliases: Mapping[str, str] = field(default_factory=dict)


class MappingError(ValueError):
    """A mapping file that can't be read, or with keys that aren't known."""


def load_mapping(path: str | Path) -> SourceMapping:
    """A mapping from a JSON file, or from a YAML one where that library is installed."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        if str(path).endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as e:
                raise MappingError("YAML files need the yaml library") from e
            data = yaml.safe_load(text) or {}
        else:
            data = json.loads(text)
    except ValueError as e:
        raise MappingError(f"{path}: {e}") from e
    if not isinstance(data, dict) or set(data) - {"sheets", "skip_rows", "delimiters", "aliases"}:
        raise MappingError(f"{path}: unknown keys {sorted(set(data) - {'sheets', 'skip_rows', 'delimiters', 'aliases'}) if isinstance(data, dict) else 'in what is no object'}")
    return SourceMapping(tuple(data.get("sheets", ())), int(data.get("skip_rows", 0)), dict(data.get("delimiters", {})), {k.lower(): v for k, v in data.get("aliases", {}).items()})


def mapped_cells(cells: DataFrame, mapping: SourceMapping) -> DataFrame:
    """Cells (path, sheet, row, col, text) of the wanted sheets and rows, with headers of aliases renamed."""
    kept = cells.filter(F.col("row") > mapping.skip_rows)
    if mapping.sheets:
        kept = kept.filter(F.col("sheet").isin(*mapping.sheets))
    if not mapping.aliases:
        return kept
    table = F.create_map(*(F.lit(x) for kv in mapping.aliases.items() for x in kv))
    first = kept.groupBy("path", "sheet").agg(F.min("row").alias("_h"))
    named = kept.join(first, ["path", "sheet"])
    alias = F.element_at(table, F.regexp_replace(F.lower(F.trim("text")), r"[:\s]+$", ""))
    return named.withColumn("text", F.when(F.col("row") == F.col("_h"), F.coalesce(alias, F.col("text"))).otherwise(F.col("text"))).drop("_h")


def section_rows(lines: DataFrame, keys: Sequence[str], section: str, order: str, text: str) -> DataFrame:
    """keys, sections: an array of name and lines, in the order in which sections begin."""
    each = lines.groupBy(*keys, section).agg(F.min(order).alias("_o"), F.array_sort(F.collect_list(F.struct(F.col(order), F.col(text)))).alias("_l"))
    body = F.struct(F.col("_o"), F.col(section).alias("name"), F.transform("_l", lambda r: r[text]).alias("lines"))
    return each.groupBy(*keys).agg(F.array_sort(F.collect_list(body)).alias("_s")).select(*keys, F.transform("_s", lambda s: F.struct(s["name"].alias("name"), s["lines"].alias("lines"))).alias("sections"))


def sections_markdown(title: Column, sections: Column) -> Column:
    """A title, and each section as a heading with its lines as items."""
    parts = F.transform(sections, lambda s: F.concat(F.lit("## "), s["name"], F.lit("\n\n"), F.array_join(F.transform(s["lines"], lambda x: F.concat(F.lit("- "), x)), "\n")))
    return F.concat(F.lit("# "), title, F.lit("\n\n"), F.array_join(parts, "\n\n"), F.lit("\n"))


def table_markdown(headers: Column, rows: Column) -> Column:
    """A table as Markdown; without headers the first row stands as one."""
    line = lambda cells: F.concat(F.lit("| "), F.array_join(F.transform(cells, lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|"))), " | "), F.lit(" |"))
    head = F.coalesce(headers, F.get(rows, 0))
    body = F.when(headers.isNull(), F.slice(rows, F.lit(2), F.greatest(F.lit(0), F.size(rows) - 1))).otherwise(rows)
    rule = F.concat(F.lit("|"), F.array_join(F.transform(head, lambda c: F.lit(" --- ")), "|"), F.lit("|"))
    return F.concat(F.concat_ws("\n", line(head), rule, F.array_join(F.transform(body, line), "\n")), F.lit("\n"))


def write_records(df: DataFrame, path: str, markdown: Column | None = None) -> None:
    """df as JSON lines below path/records, and, where asked for, a Markdown text a row as path/markdown. Each is committed as a whole."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(f"{path}/records")
    if markdown is not None:
        df.select(markdown.alias("value")).write.mode("overwrite").text(f"{path}/markdown")


def write_raw(df: DataFrame, path: str) -> None:
    """name, kind and content (binary) of raw artifacts, as Parquet; texts and JSON are their bytes."""
    df.select("name", "kind", F.col("content").cast("binary").alias("content")).write.mode("overwrite").parquet(path)


class Session:
    """Answers requests over one table that stays loaded: each a JSON object with an action and an id, each answer one with that id, ok, and result or error."""

    def __init__(self, spark: SparkSession, load: Callable[[SparkSession], DataFrame], actions: Mapping[str, Callable[[DataFrame, dict], Any]]):
        self.spark, self.load, self.actions, self.rows = spark, load, dict(actions), None

    def table(self) -> DataFrame:
        if self.rows is None:
            self.rows = self.load(self.spark).cache()
        return self.rows

    def reload(self) -> int:
        if self.rows is not None:
            self.rows.unpersist()
        self.rows = None
        return self.table().count()

    def answer(self, line: str) -> dict:
        try:
            request = json.loads(line)
            if not isinstance(request, dict):
                raise TypeError("a request is an object")
        except (ValueError, TypeError) as e:
            return {"id": None, "ok": False, "error": str(e)}
        action = request.get("action")
        try:
            if action == "ping":
                result: Any = "pong"
            elif action in ("load", "reload"):
                result = {"rows": self.reload() if action == "reload" else self.table().count()}
            elif action in self.actions:
                result = self.actions[action](self.table(), request)
            else:
                raise ValueError(f"unknown action {action!r}")
        except Exception as e:  # whatever a query raises is an answer, not the end of the session
            return {"id": request.get("id"), "ok": False, "error": f"{type(e).__name__}: {e}".splitlines()[0]}
        rows = [r.asDict(recursive=True) for r in result.collect()] if isinstance(result, DataFrame) else result  # views are summaries
        return {"id": request.get("id"), "ok": True, "result": rows}

    def serve(self, lines: Iterable[str]) -> Iterator[str]:
        for line in lines:
            if line.strip():
                yield json.dumps(self.answer(line), sort_keys=True, default=str)


#: A progress message: a marker and a JSON object.
PROGRESS = "struct<type:string,message:string,stage_label:string,work_unit_label:string,task_current:int,task_total:int,running_workers:int,worker_total:int>"


def progress(x: Column, marker: str = "__stage_progress__ ") -> Column:
    """The object of a progress message, its counter within 0 and its total; null for any other text."""
    t = F.trim(x)
    body = F.from_json(F.when(F.startswith(t, F.lit(marker.strip())), F.trim(F.substring(t, F.lit(len(marker.strip()) + 1), F.length(t)))), PROGRESS)
    total = F.greatest(F.lit(0), body["task_total"])
    current = F.when(total > 0, F.greatest(F.lit(0), F.least(body["task_current"], total))).otherwise(0)
    both = body["task_current"].isNotNull() & body["task_total"].isNotNull()
    clean = F.struct(F.trim(body["message"]).alias("message"), F.trim(body["stage_label"]).alias("stage"), F.when(both, current).alias("current"), F.when(both, total).alias("total"), F.greatest(F.lit(0), body["running_workers"]).alias("running"))
    return F.when(F.lower(F.trim(body["type"])) == "stage_progress", clean)
