"""JSON lines and JSON arrays, read with a schema, an ordinal and a channel for bad rows."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cliplake.functions.text import strip
from cliplake.session import write_out

BAD = "_corrupt"


def lines(spark: SparkSession, path: str | list[str], exact: bool = True) -> DataFrame:
    """(file, line_no, line) of every line of every file; files of any size are split.

    ``exact`` numbers a file's lines from 1, blank ones included, by the line counts of the blocks before.
    Otherwise ``line_no`` is a unique number that only sorts as the lines do, for which nothing is counted: a
    block's place in the file plus the line's place among its task's lines, of which there are fewer than bytes.
    """
    block, at = F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    placed = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), block.alias("block"), at.alias("at"), F.col("value").alias("line"))
    if not exact:
        return placed.select("file", (F.col("block") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("line_no"), "line")
    blocks = write_out(placed.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first")))  # one row per block
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = blocks.select("file", "block", (F.coalesce(before, F.lit(0)) - F.col("first") + 1).alias("offset"))
    return placed.join(offsets, ["file", "block"]).select("file", (F.col("at") + F.col("offset")).alias("line_no"), "line")


def parsed(rows: DataFrame, text: str, schema: str) -> DataFrame:
    """``rows`` with the fields of their JSON object, and the raw text in ``_corrupt`` where it is none.

    A malformed text, one that is no object, or a field of a wrong type makes a bad row; so does a blank text.
    """
    clean = strip(F.col(text))
    made = F.from_json(clean, f"{schema}, {BAD} STRING", {"columnNameOfCorruptRecord": BAD, "mode": "PERMISSIVE"})
    is_object = clean.startswith("{")
    out = rows.withColumn("_json", F.when(is_object, made))
    fields = [f.name for f in out.schema["_json"].dataType.fields if f.name != BAD]
    bad = F.when(~F.coalesce(is_object, F.lit(False)), F.coalesce(F.col(text), F.lit(""))).otherwise(F.col(f"_json.{BAD}"))
    keep = [c for c in rows.columns if c != text]
    return out.select(*keep, *(F.col(f"_json.{f}").alias(f) for f in fields), bad.alias(BAD))


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = False, exact: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows (file, line_no, _corrupt)); blank lines are neither. ``strict`` fails on a bad row.

    ``exact`` as in :func:`lines`.
    """
    rows = parsed(lines(spark, path, exact).where(strip(F.col("line")) != ""), "line", schema)
    if strict:
        bad = F.when(F.col(BAD).isNotNull(), F.raise_error(F.concat(F.lit("bad line "), F.col("line_no").cast("string"))).cast("boolean")).otherwise(True)
        return rows.where(bad).drop(BAD), rows.where(F.lit(False)).select("file", "line_no", BAD)
    return rows.where(F.col(BAD).isNull()).drop(BAD), rows.where(F.col(BAD).isNotNull()).select("file", "line_no", BAD)


def read_json_array(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """(file, line_no, fields): the objects of JSON array files, numbered by element; other elements are skipped.

    An array is one JSON text and cannot be split: each such file must fit a task.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    elements = F.posexplode(F.from_json("value", "array<variant>")).alias("at", "v")
    rows = files.select("file", elements).select("file", (F.col("at") + 1).cast("long").alias("line_no"), F.to_json("v").alias("line"))
    return parsed(rows, "line", schema).where(F.col(BAD).isNull()).drop(BAD)


def sniffed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(file, line_no, fields) of ``.json`` array files and of JSON-lines files, also of those named ``.json``.

    A ``.json`` file is an array if its first character that is no white space is a bracket. Only arrays are
    read whole; in the others ``line_no`` sorts as the lines do.
    """
    names = sorted(unquote(f) for f in spark.read.text(path).inputFiles())
    odd = [f for f in names if f.lower().endswith(".json")]
    arrays: list[str] = []
    if odd:
        written = lines(spark, odd, exact=False).where(strip(F.col("line")) != "")
        first = written.groupBy("file").agg(F.min_by(F.left(strip(F.col("line")), F.lit(1)), "line_no").alias("c"))
        arrays = sorted(unquote(r.file) for r in first.where("c = '['").collect())  # names of files
    rest = [f for f in names if f not in set(arrays)]
    found = []
    if arrays:
        found.append(read_json_array(spark, arrays, schema))
    if rest or not arrays:
        found.append(parsed(lines(spark, rest or path, exact=False), "line", schema).where(F.col(BAD).isNull()).drop(BAD))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def json_type(text: Column, field: str) -> Column:
    """The JSON type of a field: absent, null, string, strings (a list of strings only), or another name."""
    value = F.variant_get(F.try_parse_json(text), f"$.{field}", "variant")
    kind = F.schema_of_variant(value)
    return (
        F.when(value.isNull(), "absent")
        .when(kind == "VOID", "null")
        .when(kind == "STRING", "string")
        .when(kind.isin("ARRAY<STRING>", "ARRAY<VOID>"), "strings")
        .otherwise(F.lower(kind))
    )


def audit_field(rows: DataFrame, order: str, text: str, field: str, most: int = 50) -> DataFrame:
    """(order, kind): the first ``most`` rows whose field is neither absent, null, a string nor a list of strings."""
    kinds = rows.select(order, json_type(F.col(text), field).alias("kind"))
    return kinds.where(~F.col("kind").isin("absent", "null", "string", "strings")).orderBy(order).limit(most)
