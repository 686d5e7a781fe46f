"""Filling containers of fixed capacity with documents that lie near each other on a space-filling curve.

Documents become hashed token vectors, randomly projected to a few dimensions; their Hilbert key orders
them along a curve; the curve is range-partitioned, and each partition packs windows of neighbours best-fit
decreasing, taking open containers along from window to window.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliplake.llm.chars import mix, text_slices
from cliplake.session import cut_lineage, table_partitions, write_out

CAPACITY = 2_048
DIMENSIONS, BITS = 3, 10
HASHED = 1 << 16  # entries of the hashed document vectors
WINDOW = 4_096  # documents that are packed together
KEPT_OPEN = 512  # containers that stay open from window to window
TOKENIZER = os.environ.get("CLIPLAKE_TOKENIZER", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: The split pattern that belongs to the rank files, a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LOADED: dict[str, object] = {}


def load_tokenizer(path: str):
    """The byte-level BPE of a rank file, loaded once per process."""
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _LOADED[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def projection() -> np.ndarray:
    """A fixed random projection of hashed vectors (HASHED x DIMENSIONS)."""
    return np.random.default_rng(20_24).standard_normal((HASHED, DIMENSIONS)).astype(np.float32)


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of integer points (n x d, each 0 .. 2**bits - 1), by the transpose method."""
    x = cells.astype(np.int64).T.copy()
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(d):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[d - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _measure(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = load_tokenizer(SparkFiles.get(tokenizer)), projection()
        for whole in batches:
            texts = whole.column("text").to_pylist()
            for at, stop in text_slices(texts):
                batch = whole.slice(at, stop - at)
                tokens = [encoder.encode_ordinary(t) for t in texts[at:stop]]
                counts = np.fromiter(map(len, tokens), np.int64, len(tokens))
                flat = np.fromiter((t for row in tokens for t in row), np.int64, int(counts.sum()))
                spot = (mix(flat.astype(np.uint64)) & np.uint64(HASHED - 1)).astype(np.int64)
                owner = np.repeat(np.arange(len(tokens)), counts)
                cols = [np.bincount(owner, table[spot, k], len(tokens)) / np.sqrt(np.maximum(counts, 1)) for k in range(DIMENSIONS)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts), *map(pa.array, cols)], names=["doc_id", "n_tokens", *(f"x{k}" for k in range(DIMENSIONS))]
                )

    return run


def best_fit(sizes: list[int], open_bins: list[tuple[int, int]], capacity: int, next_id: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]], int]:
    """Best-fit decreasing of the sizes into the open bins (bin, free) and new ones.

    Returns (bin, offset) of each size in the given order, the bins with room left, and the next bin number.
    """
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for b, free in open_bins:
        by_free[free].append(b)
        mask |= 1 << free
    placed: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[i]
        fits = mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                mask &= ~(1 << free)
        else:
            free, b, next_id = capacity, next_id, next_id + 1
        placed[i] = (b, capacity - free)
        left = free - size
        by_free[left].append(b)
        mask |= 1 << left
    rest = [(b, free) for free in range(capacity, 0, -1) for b in by_free[free]]
    return placed, rest, next_id


def _pack(capacity: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pending: list[pd.DataFrame] = []
        held, open_bins, next_id = 0, [], 0

        def emit(pdf: pd.DataFrame) -> pd.DataFrame:
            nonlocal open_bins, next_id
            placed, open_bins, next_id = best_fit(pdf["size"].tolist(), open_bins, capacity, next_id)
            open_bins = open_bins[:KEPT_OPEN]  # the emptiest stay open, the fullest are closed
            base = int(pdf["pid"].iat[0]) << 40
            out = pdf[["doc_id", "piece", "token_start", "size", "key"]].rename(columns={"size": "n_tokens", "key": "curve_key"})
            return out.assign(container_id=[base + b for b, _ in placed], offset=[o for _, o in placed])

        for pdf in batches:
            pending.append(pdf)
            held += len(pdf)
            while held >= WINDOW:
                whole = pd.concat(pending)
                yield emit(whole.iloc[:WINDOW])
                pending, held = [whole.iloc[WINDOW:]], held - WINDOW
        if held:
            yield emit(pd.concat(pending))

    return run


def pack_documents(documents: DataFrame, doc: str, text: str, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, partitions: int | None = None) -> DataFrame:
    """(doc_id, piece, token_start, n_tokens, curve_key, container_id, offset): where every piece of a text lies.

    A text of up to ``capacity`` tokens is one piece; a longer one is cut into pieces of the whole capacity
    and a rest. ``container_id`` names a container, ``offset`` the piece's first token in it. Null texts have
    no tokens and no row; an empty text is one piece of no tokens. Repeated rows are packed each, null ids
    are kept. An empty table gives no rows; other columns are not read.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("text is not null")
    names = [f"x{k}" for k in range(DIMENSIONS)]
    spark.sparkContext.addFile(tokenizer)  # the driver serves the rank file: the executors need no copy of their own
    measured = write_out(rows.mapInArrow(_measure(os.path.basename(tokenizer)), "doc_id long, n_tokens long, " + ", ".join(f"{x} double" for x in names)))
    spread = measured.agg(*(F.avg(x).alias(f"m_{x}") for x in names), *(F.stddev_pop(x).alias(f"s_{x}") for x in names)).first()
    centre = [spread[f"m_{x}"] or 0.0 for x in names]
    width = [max(spread[f"s_{x}"] or 0.0, 1e-9) for x in names]

    @F.pandas_udf("long")
    def curve(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        at = np.stack([(s.to_numpy(float) - m) / w for s, m, w in zip((a, b, c), centre, width, strict=True)], axis=1)
        share = 1 / (1 + np.exp(-1.702 * np.clip(at, -8, 8)))  # close to the normal distribution function
        return pd.Series(hilbert_key(np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)))

    whole = F.floor(F.col("n_tokens") / capacity).cast("long")
    last = F.when((F.col("n_tokens") % capacity > 0) | (F.col("n_tokens") == 0), whole).otherwise(whole - 1)
    pieces = measured.withColumn("key", curve(*names)).select("doc_id", "n_tokens", "key", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    sized = pieces.select(
        "doc_id", "key", "piece", (F.col("piece") * capacity).alias("token_start"), F.least(F.lit(capacity), F.col("n_tokens") - F.col("piece") * capacity).alias("size")
    )
    count = partitions or table_partitions(spark)
    ranged = sized.repartitionByRange(count, "key", "doc_id", "piece").sortWithinPartitions("key", "doc_id", "piece")
    out = "doc_id long, piece long, token_start long, n_tokens long, curve_key long, container_id long, offset long"
    return cut_lineage(ranged.withColumn("pid", F.spark_partition_id()).mapInPandas(_pack(capacity), out))
