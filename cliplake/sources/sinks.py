"""JSON-lines sinks and plans of file actions."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliplake.functions.verdict import denied
from cliplake.session import write_out


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", one_file: bool = False, keep_nulls: bool = True) -> None:
    """Rows as JSON lines, unescaped UTF-8; ``one_file`` is for exports that fit one task."""
    rows = df.coalesce(1) if one_file else df
    rows.write.mode(mode).option("ignoreNullFields", str(not keep_nulls).lower()).json(path)


def write_json_array(df: DataFrame, path: str) -> int:
    """Rows as one pretty JSON array in a local file, streamed through the driver; no file if there are no rows."""
    n = 0
    out = None
    try:
        for r in df.select(to_line(*df.columns).alias("line")).toLocalIterator():
            out = out or open(path, "w", encoding="utf-8")  # noqa: SIM115
            out.write(("[\n" if not n else ",\n") + json.dumps(json.loads(r.line), ensure_ascii=False, indent=2))
            n += 1
        if out:
            out.write("\n]\n")
    finally:
        if out:
            out.close()
    return n


def to_line(*columns: str) -> Column:
    """The row as one JSON text, nulls written."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def delete_plan(verdicts: DataFrame, listing: DataFrame, base: str = "") -> DataFrame:
    """(path, sidecar, exists): what a deletion by verdict would remove. Nothing is removed here."""
    from cliplake.functions.paths import sidecar
    from cliplake.functions.text import or_else

    named = verdicts.where(denied(F.col("reason"))).select(or_else("video_path", "video_filename").alias("path")).where("path is not null").distinct()
    if base:
        named = named.select(F.when(F.col("path").startswith("/"), F.col("path")).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), "path")).alias("path"))
    known = listing.select(F.col("path").alias("known")).distinct()
    return named.join(known, F.col("path") == F.col("known"), "left").select("path", sidecar(F.col("path")).alias("sidecar"), F.col("known").isNotNull().alias("exists"))


def run_file_actions(plan: DataFrame, action: str, source: str = "path", target: str | None = None, execute: bool = False) -> DataFrame:
    """(path, status) of deleting or copying the plan's local files; a dry run unless ``execute``.

    Runs once: what is there is written down first, then the outcome, so that reading the result again or a
    retried task finds nothing to report as missing that an earlier attempt has removed.
    """
    names = plan.select(F.col(source).alias("path"), (F.col(target) if target else F.lit(None).cast("string")).alias("target")).where("path is not null")

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(status=["planned" if os.path.exists(p) else "missing" for p in pdf["path"]])

    def apply(path: str, to: str | None) -> str:
        try:
            if action == "copy":
                shutil.copy2(path, f"{to}.part")
                os.replace(f"{to}.part", to)
            elif os.path.exists(path):
                os.remove(path)
            return "done"
        except OSError as x:
            return f"failed: {x.strerror}"

    def act(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = [apply(p, t) if s == "planned" else s for p, t, s in zip(pdf["path"], pdf["target"], pdf["status"], strict=True)]
            yield pd.DataFrame({"path": pdf["path"], "status": done})

    if action not in ("copy", "delete"):
        raise ValueError(f"no file action {action!r}")
    seen = write_out(names.mapInPandas(look, "path string, target string, status string"))
    return write_out(seen.mapInPandas(act, "path string, status string")) if execute else seen.select("path", "status")
