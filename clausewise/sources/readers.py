"""Readers for reviews, places, clauses, blocks and judgements."""

from __future__ import annotations

import os
import warnings

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clausewise.functions.text import not_blank, strip

from .json_arrays import read_json_array

CLAUSE = "clause_id string, clause_text string, place_name string, review_id string, sentence_no int, score double"
BLOCK = "cluster_id int, clauses array<string>, place_names array<string>, size int"


def csv(spark: SparkSession, path: str, columns: dict[str, str] | None = None, encoding: str = "UTF-8", empty: bool = True) -> DataFrame:
    """CSV with a header, quoted line breaks and a byte-order mark, all columns strings.

    ``columns`` maps source names to output names; a name that is absent raises.  Spark reads an
    empty cell as null; with ``empty`` it is the empty string again.  ``seq`` is the order of rows.
    """
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', encoding=encoding)
    if columns is not None:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"columns not in {path}: {', '.join(missing)}")
        df = df.select(*[F.col(a).alias(b) for a, b in columns.items()])
    if empty:
        df = df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in df.columns])
    return df.withColumn("seq", F.monotonically_increasing_id())


def jsonl(spark: SparkSession, path: str, schema: str, malformed: str = "fail") -> DataFrame:
    """JSON lines: ``malformed`` is fail, skip, or keep (in the column ``_corrupt_record``)."""
    mode = {"fail": "FAILFAST", "skip": "DROPMALFORMED", "keep": "PERMISSIVE"}[malformed]
    kind = T.StructType.fromDDL(schema)
    if malformed == "keep":
        kind = kind.add("_corrupt_record", "string")
    return spark.read.schema(kind).json(path, mode=mode).withColumn("seq", F.monotonically_increasing_id())


def jsonl_counted(spark: SparkSession, path: str, schema: str, counts: Observation) -> DataFrame:
    """JSON lines without the malformed ones; ``counts`` has lines and skipped once an action has run over
    the rows, from the same pass."""
    rows = jsonl(spark, path, schema, "keep").observe(counts, F.count("*").alias("lines"), F.count("_corrupt_record").alias("skipped"))
    return rows.where("_corrupt_record is null").drop("_corrupt_record")


def skipped_lines(spark: SparkSession, path: str, schema: str) -> int:
    """Lines that ``jsonl`` skips, for a warning."""
    kind = T.StructType.fromDDL(schema).add("_corrupt_record", "string")
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.where(F.from_json("value", kind, {"columnNameOfCorruptRecord": "_corrupt_record"})["_corrupt_record"].isNotNull()).count()


def dense(df: DataFrame, column: str = "seq", first: int = 1, part: str | None = None) -> DataFrame:
    """``column``, as ``monotonically_increasing_id`` gave it, without gaps: rows are numbered inside
    the partition that numbered them and moved on by the rows of those before it, so no task holds
    more than a partition.  ``part`` names a column (it goes) that orders the rows before that."""
    rows = df.withColumn("__p", F.col(part) if part else F.shiftright(column, 33))
    counts = rows.groupBy("__p").agg(F.count("*").alias("__n"))  # a row a partition
    before = counts.select("__p", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__b"))
    inside = F.row_number().over(Window.partitionBy("__p").orderBy(column))
    return rows.join(before, "__p").withColumn(column, F.col("__b") + inside + (first - 1)).drop("__p", "__b", *([part] if part else []))


def in_file_order(df: DataFrame) -> DataFrame:
    """A table just read from files with ``seq`` and with ``__file``, the file and the place in it
    that a row's split began at: Spark deals files by size, and names tell their order."""
    return df.withColumns({"__file": F.struct("_metadata.file_path", "_metadata.file_block_start"), "seq": F.monotonically_increasing_id()})


def metadata(spark: SparkSession, path: str, schema: str = CLAUSE) -> DataFrame:
    """JSON lines with ``position`` from 0, to be joined with vectors by position.  A missing file is
    an empty table and a warning."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        warnings.warn(f"no metadata at {path}", stacklevel=2)
        return spark.createDataFrame([], schema + ", position long")
    rows = in_file_order(spark.read.schema(schema).json(path, mode="FAILFAST"))
    return dense(rows, first=0, part="__file").withColumnRenamed("seq", "position")


def vector_index(spark: SparkSession, path: str) -> DataFrame:
    """(position, embedding) of an index that ``writers.vector_index`` wrote."""
    return spark.read.schema("position long, embedding array<float>").parquet(path)


def block_lines(spark: SparkSession, path: str) -> DataFrame:
    """(cluster_id, clauses) of JSON lines of any accepted shape; a cluster's number is its position
    among the lines that hold clauses, whatever number the line itself gives."""
    lines = in_file_order(spark.read.text(path)).withColumn("clauses", block_texts(F.col("value")))
    return dense(lines.where(F.size("clauses") > 0), part="__file").select(F.col("seq").cast("int").alias("cluster_id"), "clauses")


def column_of(spark: SparkSession, path: str, name: str = "Reviews") -> DataFrame:
    """The column under the header ``name``, by position; rows too short to have it and blank ones
    are left out, and the rest are numbered from 1."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', mode="PERMISSIVE")
    if name not in df.columns:
        raise ValueError(f"no column {name} in {path}")
    rows = in_file_order(df).select("seq", "__file", strip(F.col(name)).alias("text"))
    return dense(rows.where(not_blank(F.col("text"))), part="__file")


def resolve(path: str, folder: str) -> str:
    """An absolute path or a URI as it is, any other against ``folder``."""
    return path if os.path.isabs(path) or "://" in path else os.path.join(folder, path)


def vectors(spark: SparkSession, path: str) -> DataFrame:
    df = jsonl(spark, path, CLAUSE + ", embedding array<float>")
    return df.where("length(clause_text) > 0 and size(embedding) > 0")


def review_array(spark: SparkSession, path: str) -> DataFrame:
    """Reviews with a text, of JSON arrays that are read by byte ranges; a rating of NaN is NaN."""
    rows = read_json_array(spark, path, "attraction_id string, date string, rating double, review_text string")
    return rows.where(not_blank(F.col("review_text")))


def first_column(spark: SparkSession, path: str, header: bool, name: str = "place") -> DataFrame:
    df = spark.read.csv(path, header=header)
    return df.select(F.col(df.columns[0]).alias(name)).where(not_blank(F.col(name))).withColumn("seq", F.monotonically_increasing_id())


def markdown(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("doc"), F.col("value").alias("text"))


def markdown_sections(spark: SparkSession, path: str, prefix: str = "## ") -> DataFrame:
    """(doc, section, header, body) of the sections of each file, in parts of a file that Spark splits: a line's
    section is the number of headers up to it, counted inside its split and moved on by those of the splits
    before it.  Lines of a single # and those before the first header are left out, empty bodies go."""
    lines = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("doc"), F.col("_metadata.file_block_start").alias("part"),
        F.monotonically_increasing_id().alias("n"), F.col("value").startswith(prefix).alias("head"))
    inside = F.sum(F.col("head").cast("int")).over(Window.partitionBy("doc", "part").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    heads = lines.groupBy("doc", "part").agg(F.sum(F.col("head").cast("int")).alias("heads"))  # a row a split
    before = heads.select("doc", "part", F.coalesce(F.sum("heads").over(
        Window.partitionBy("doc").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    marked = lines.withColumn("inside", inside).join(before, ["doc", "part"]).withColumn("section", F.col("inside") + F.col("before")).where("section > 0")
    body = F.when(~F.col("head") & ~F.col("line").startswith("# "), F.struct("part", "n", "line"))
    out = marked.groupBy("doc", "section").agg(
        F.max(F.when(F.col("head"), strip(F.substring("line", len(prefix) + 1, 1 << 30)))).alias("header"),
        strip(F.array_join(F.transform(F.array_sort(F.collect_list(body)), lambda x: x["line"]), "\n")).alias("body"))
    return out.where("body <> ''").select("doc", "section", "header", "body")


def judgements(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    return df.select(*[(F.coalesce(c, F.lit("")) if c in df.columns else F.lit("")).alias(c) for c in ("location_name", "judgement", "action")])


# Keys that may hold the clauses of a block, and the text of a clause, in order of priority.
BLOCK_KEYS = ("clauses", "items", "members", "samples", "text", "issue", "issues")
TEXT_KEYS = ("clause_text", "clause", "text")


def block_texts(line: Column, depth: int = 16) -> Column:
    """Clauses of one JSON line of any shape.

    A string is its own clause.  A list gives its strings and the texts of its objects; other
    elements, lists among them, give none.  An object is searched under each of the keys in turn, in the
    same way, and the first that gives any clause counts; if none does, the object itself is one
    clause, by its text.  The text of an object is the first of its text keys that holds something (an
    empty string, a zero, false, null or an empty list does not), if that is a string.  Blank strings
    are no clauses.  A line that is no JSON has none.  Objects are followed ``depth`` deep.

    The walk is one expression: each of ``depth`` steps turns the objects reached so far into what lies
    under their keys.  Every place has a path of key numbers, an object's own text comes after all of its
    keys, and the clauses of the least path that has any are the answer.
    """
    def kind(v):
        return F.schema_of_variant(v)

    def holds(v):
        return v.isNotNull() & ~F.to_json(v).isin("null", '""', "false", "[]", "{}") & F.coalesce(
            F.when(~kind(v).isin("STRING", "BOOLEAN") & ~kind(v).rlike("^(OBJECT|ARRAY)"), F.try_variant_get(v, "$", "double") != 0), F.lit(True))

    def string(v):
        own = F.try_variant_get(v, "$", "string")
        return F.when((kind(v) == "STRING") & not_blank(own), own)

    def text_of(v):
        said = [F.try_variant_get(v, f"$.{k}", "variant") for k in TEXT_KEYS]
        chosen = F.when(holds(said[0]), said[0]).when(holds(said[1]), said[1]).otherwise(said[2])
        return string(chosen)

    def texts(x):
        own = F.when(kind(x["v"]).startswith("ARRAY"), F.transform(
            F.try_variant_get(x["v"], "$", "array<variant>"), lambda v: F.when(kind(v).startswith("OBJECT"), text_of(v)).otherwise(string(v))))
        own = own.when(kind(x["v"]).startswith("OBJECT"), F.array(text_of(x["v"]))).otherwise(F.array(string(x["v"])))
        path = F.when(kind(x["v"]).startswith("OBJECT"), F.concat(x["path"], F.lit(str(len(BLOCK_KEYS))))).otherwise(x["path"])
        return F.struct(path.alias("path"), F.array_compact(own).alias("texts"))

    def under(x):
        held = F.array(*[F.struct(F.concat(x["path"], F.lit(str(i))).alias("path"), F.try_variant_get(x["v"], f"$.{k}", "variant").alias("v")) for i, k in enumerate(BLOCK_KEYS)])
        return F.filter(held, lambda y: y["v"].isNotNull())

    def step(state, _):
        found = F.filter(F.transform(state["open"], texts), lambda x: F.size(x["texts"]) > 0)
        objects = F.filter(state["open"], lambda x: kind(x["v"]).startswith("OBJECT"))
        more = F.struct(F.flatten(F.transform(objects, under)).alias("open"), F.concat(state["found"], found).alias("found"))
        return F.when(F.size(state["open"]) > 0, more).otherwise(state)

    v = F.try_parse_json(line)
    start = F.struct(
        F.when(v.isNotNull(), F.array(F.struct(F.lit("").alias("path"), v.alias("v")))).otherwise(F.array().cast("array<struct<path:string,v:variant>>")).alias("open"),
        F.array().cast("array<struct<path:string,texts:array<string>>>").alias("found"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), start, step, lambda s: F.coalesce(F.array_min(s["found"])["texts"], F.array().cast("array<string>")))


def load_env(path: str) -> dict[str, str]:
    """KEY=value lines of a file that are not set yet; nothing is overridden."""
    found = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            for line in f:
                key, eq, value = line.strip().partition("=")
                if eq and not key.startswith("#"):
                    found[key.strip()] = os.environ.setdefault(key.strip(), value.strip().strip("\"'"))
    return found
