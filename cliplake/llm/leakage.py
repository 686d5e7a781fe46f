"""Evaluation texts leaking into training text: size-partitioned MinHash containment search.

Test items are partitioned by size; each keeps its smallest shingle hashes as a MinHash sketch, and each
partition the threshold below which its sketches lie. A document's own MinHash values under the threshold
grow with its length, so that the containment of a short item in a long document is estimated without
comparing their sizes. Documents that meet enough of a sketch are verified exactly on the item's shingles.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliplake.llm.chars import code_points, text_slices, window_hashes
from cliplake.session import write_out

SHINGLE = 10
CONTAINMENT = 0.4
SKETCH = 96
#: An item's expected sketch hits at the threshold are 0.4 * 96 = 38 (standard deviation 4.8).
LEAST_HITS = 0.15
#: Items up to which their sketches go to every task; those of more are joined.
MAX_ITEMS = 20_000
SLOTS = 1 << 22  # size of the candidate filter, fixed whatever the data

_ALNUM: np.ndarray | None = None


def _alnum() -> np.ndarray:
    global _ALNUM
    if _ALNUM is None:
        _ALNUM = np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
    return _ALNUM


def normalise(text: str | None) -> str:
    """NFKC, lower case, letters and digits only."""
    return "".join(c for c in unicodedata.normalize("NFKC", text or "").lower() if c.isalnum())


def _batch(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The normalised texts of a batch as code points and offsets."""
    flat, offsets = code_points([unicodedata.normalize("NFKC", t or "").lower() for t in texts])
    keep = _alnum()[flat]
    return flat[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


@dataclass(frozen=True)
class Partition:
    """The sketches of the items of one size class: what a document's MinHash values are met with."""

    top: np.uint64  # the largest sketch value: documents keep their values up to it
    filter: np.ndarray  # which low bits of a value occur in the sketches
    hashes: np.ndarray  # sketch values, sorted
    items: np.ndarray  # the item of each value
    least: np.ndarray  # hits that an item needs, by item


def build_partitions(items: list[tuple[int, str]], shingle: int, size: int = SKETCH) -> list[Partition]:
    """Partitions of the items by the power of two of their number of shingles.

    Items of more than ``size`` shingles keep their ``size`` smallest hashes, smaller ones all. The larger a
    partition's items, the lower its threshold, and the fewer of a document's values it looks at.
    """
    by: dict[int, list[tuple[int, np.ndarray]]] = {}
    for k, (_, text) in enumerate(items):
        own = np.unique(window_hashes(*code_points([normalise(text)]), shingle)[0])
        by.setdefault(len(own).bit_length(), []).append((k, own[:size]))
    out = []
    for group in by.values():
        hashes = np.concatenate([h for _, h in group])
        index = np.concatenate([np.full(len(h), k) for k, h in group])
        order = np.argsort(hashes, kind="stable")
        bits = np.zeros(1 << min(24, max(12, (64 * len(hashes)).bit_length())), bool)
        bits[(hashes >> np.uint64(3)) & np.uint64(len(bits) - 1)] = True
        least = np.zeros(len(items), np.int64)
        for k, h in group:
            least[k] = max(1, int(LEAST_HITS * len(h)))
        out.append(Partition(hashes.max(), bits, hashes[order], index[order], least))
    return out


def _meet(hashes: np.ndarray, owner: np.ndarray, part: Partition) -> tuple[np.ndarray, np.ndarray]:
    """(document, item) index pairs of a batch whose hits reach the least number of the item's sketch."""
    kept = hashes <= part.top  # the documents' own MinHash values
    kept &= part.filter[(hashes >> np.uint64(3)) & np.uint64(len(part.filter) - 1)]
    owner, hashes = owner[kept], hashes[kept]
    lo = np.searchsorted(part.hashes, hashes, "left")
    met = part.hashes[np.minimum(lo, len(part.hashes) - 1)] == hashes
    # a document meets each sketch value once
    once = np.unique(owner[met] * len(part.hashes) + lo[met])
    docs, lo = once // len(part.hashes), once % len(part.hashes)
    times = np.searchsorted(part.hashes, part.hashes[lo], "right") - lo
    doc = np.repeat(docs, times)
    first = np.cumsum(times) - times
    item = part.items[np.repeat(lo - first, times) + np.arange(len(doc))]
    n = len(part.least)
    key, hits = np.unique(doc * n + item, return_counts=True)
    doc, item = key // n, key % n
    enough = hits >= part.least[item]
    return doc[enough], item[enough]


def _word_bits(slots: DataFrame) -> np.ndarray:
    """A bitmap of SLOTS bits with those of the column slot set; at most SLOTS / 64 rows come to the driver."""
    words = slots.groupBy(F.shiftright("slot", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, CAST(slot % 64 AS INT))) AS bits"))
    bitmap = np.zeros(SLOTS // 64, np.uint64)
    for r in words.collect():
        bitmap[r.w] = np.uint64(r.bits & 0xFFFFFFFFFFFFFFFF)
    return bitmap


def _in_bitmap(bitmap: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bitmap[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) > 0


def _search_shipped(docs: DataFrame, rows: list[tuple[int, str]], shingle: int) -> DataFrame:
    """Candidates (doc_id, item) by sketches that go to every task; ``item`` is the row's number."""
    shared = docs.sparkSession.sparkContext.broadcast(build_partitions(rows, shingle))  # bounded by max_items

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            texts = whole.column("text").to_pylist()
            for at, stop in text_slices(texts, 1_000):
                ids = whole.column("doc_id").slice(at, stop - at).to_numpy(zero_copy_only=False).astype(np.int64)
                hashes, owner = window_hashes(*_batch(texts[at:stop]), shingle)
                for part in shared.value:
                    d, k = _meet(hashes, owner, part)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[d]), pa.array(k.astype(np.int64))], names=["doc_id", "item"])

    return docs.mapInArrow(search, "doc_id long, item long").distinct()


def _search_joined(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """Candidates (doc_id, item) by a join of the documents' MinHash values with the sketches of any number of items."""
    flip = np.uint64(1 << 63)  # so that signed values sort as the hashes do

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            own = [np.unique(window_hashes(*code_points([normalise(t)]), shingle)[0])[:SKETCH] for t in pdf["t"]]
            least = [max(1, int(LEAST_HITS * len(h))) for h in own]
            out = pd.DataFrame({"item": pdf["item"].to_numpy(), "least": least, "h": [(h ^ flip).view(np.int64) for h in own]})
            yield out[out["h"].map(len) > 0]

    sketches = write_out(wanted.mapInPandas(sketch, "item long, least int, h array<long>").select("item", "least", F.explode("h").alias("h")))
    top = sketches.agg(F.max("h")).first()[0]
    if top is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item long")
    shared = docs.sparkSession.sparkContext.broadcast(_word_bits(sketches.select(F.pmod("h", F.lit(SLOTS)).alias("slot"))))  # SLOTS bits

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            texts = whole.column("text").to_pylist()
            for at, stop in text_slices(texts, 1_000):
                ids = whole.column("doc_id").slice(at, stop - at).to_numpy(zero_copy_only=False).astype(np.int64)
                hashes, owner = window_hashes(*_batch(texts[at:stop]), shingle)
                signed = (hashes ^ flip).view(np.int64)
                kept = (signed <= top) & _in_bitmap(shared.value, signed & (SLOTS - 1))
                yield pa.RecordBatch.from_arrays([pa.array(ids[owner[kept]]), pa.array(signed[kept])], names=["doc_id", "h"])

    met = docs.mapInArrow(values, "doc_id long, h long").distinct().join(sketches, "h")
    return met.groupBy("doc_id", "item").agg(F.count("*").alias("hits"), F.first("least").alias("least")).where("hits >= least").select("doc_id", "item")


def leaked_passages(
    documents: DataFrame, doc: str, text: str, items: DataFrame, item: str, item_text: str, containment: float = CONTAINMENT, shingle: int = SHINGLE, max_items: int = MAX_ITEMS
) -> DataFrame:
    """(doc_id, item_id, contained) of documents that hold at least ``containment`` of an item's shingles.

    Shingles are the distinct substrings of ``shingle`` characters of the normalised text. Null or too short
    texts and items match nothing; null ids are left out; repeated rows give one row per id. Empty tables
    give no rows. Up to ``max_items`` items go to every task; more are joined by their sketches' values, with
    the same result.

    The candidate step is made for a containment of 0.4 or more; a lower one is an error.
    """
    if containment < CONTAINMENT:
        raise ValueError(f"containment {containment} is below {CONTAINMENT}, for which the sketches are made")
    spark = documents.sparkSession
    wanted = items.select(F.col(item).cast("long").alias("i"), F.col(item_text).cast("string").alias("t")).where("i is not null and t is not null").distinct()
    rows = sorted((r.i, r.t) for r in wanted.limit(max_items + 1).collect())
    docs = documents.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("doc_id is not null and text is not null")
    if len(rows) <= max_items:
        rows = [(i, t) for i, t in rows if len(normalise(t)) >= shingle]
        if not rows:
            return spark.createDataFrame([], "doc_id long, item_id long, contained double")
        numbered = spark.createDataFrame([(k, i, t) for k, (i, t) in enumerate(rows)], "item long, i long, t string")
        candidates = write_out(_search_shipped(docs, rows, shingle))
    else:
        numbered = write_out(wanted.select(F.xxhash64("i", "t").alias("item"), "i", "t"))
        candidates = write_out(_search_joined(docs, numbered.select("item", "t"), shingle))
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS))
    bitmap = _word_bits(candidates.select(slot.alias("slot")))

    @F.pandas_udf("boolean")
    def possible(s: pd.Series) -> pd.Series:
        return pd.Series(_in_bitmap(bitmap, s.to_numpy(np.int64)))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            shares = []
            known: dict[str, set[str]] = {}
            last, plain = None, ""
            for t, held in zip(pdf["text"], pdf["t"], strict=True):
                if t is not last:
                    last, plain = t, normalise(t)
                if held not in known:
                    n = normalise(held)
                    known[held] = {n[k : k + shingle] for k in range(len(n) - shingle + 1)}
                grams = known[held]
                shares.append(sum(s in plain for s in grams) / len(grams))
            out = pdf[["doc_id", "item_id"]].assign(contained=shares)
            yield out[out["contained"] >= containment - 1e-12]

    texts = docs.withColumn("slot", slot).where(possible("slot")).select("doc_id", "text")
    both = texts.join(candidates, "doc_id").join(numbered, "item").select("doc_id", "text", F.col("i").alias("item_id"), "t")
    return both.mapInPandas(verify, "doc_id long, item_id long, contained double").groupBy("doc_id", "item_id").agg(F.max("contained").alias("contained"))
