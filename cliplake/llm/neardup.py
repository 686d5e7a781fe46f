"""Near-duplicate records with small edits, by pigeonhole blocks over fingerprints.

A record's fingerprint is a string of MinHash symbols of its character shingles (one-permutation hashing,
several passes). It is cut into blocks: two fingerprints whose Hamming distance is below the number of
blocks agree in one block whole, for certain. Pairs at the threshold of similarity are further apart than
that; they share a block with high probability only, as in banding (a miss has 0.0067 at 0.7). Texts are
joined on blocks, filtered by the Hamming distance of a bit sketch, and verified exactly on their shingle
sets. The exact mode has no such chances: it joins texts on the rarest of their shingles, of which two similar
texts must share one, and verifies all pairs met.
Exact copies are one text throughout and are expanded at the end only.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliplake.llm.chars import code_points, mix, text_slices, window_hashes
from cliplake.llm.components import components
from cliplake.session import write_out

WHITE = r"(?U)[\s\x1c-\x1f]+"
SHINGLE = 3
MIN_CHARS = 40
THRESHOLD = 0.7
PASSES, BINS, BLOCK = 4, 60, 6
BLOCKS = PASSES * BINS // BLOCK
SKETCH_BITS = 64
#: Of 64 sketch bits, a pair at similarity 0.7 differs in 9.6 on average (standard deviation 2.9).
MAX_SKETCH_DISTANCE = 24
#: A pair that agrees in one block only must be closer (at similarity 0.7, 4 in 100,000 pairs are not).
MAX_LONE_DISTANCE = 18
SLOTS = 1 << 23  # size of the candidate filter, fixed whatever the data

_FP = pa.schema(
    [("srch", pa.int32()), ("rec", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("sketch", pa.int64()), ("blocks", pa.list_(pa.int32()))]
)
_FP_DDL = "srch int, rec long, k1 long, k2 long, sketch long, blocks array<int>"


def symbols(texts: list[str], shingle: int = SHINGLE) -> np.ndarray:
    """MinHash symbols (texts x PASSES * BINS) of the character shingles; each text needs at least one."""
    flat, offsets = code_points(texts)
    hashes, owner = window_hashes(flat, offsets, shingle)
    n = len(texts)
    out = np.empty((n, PASSES, BINS), np.uint32)
    for p in range(PASSES):
        v = mix(hashes + np.uint64((2 * p + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        slot = owner * BINS + ((v >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
        low = np.full(n * BINS, 0xFFFFFFFF, np.uint32)
        np.minimum.at(low, slot, (v & np.uint64(0xFFFFFFFE)).astype(np.uint32))
        low = low.reshape(n, BINS)
        empty = low == 0xFFFFFFFF
        hops = 0
        while empty.any():  # an empty bin borrows from the next full one, marked by its distance
            hops += 1
            away = np.uint32(hops * 0x9E3779B1 % (1 << 32))
            near = np.roll(low, -1, axis=1)
            fill = empty & (near != 0xFFFFFFFF)
            if not fill.any():
                break
            low = np.where(fill, (near ^ away) & np.uint32(0xFFFFFFFE), low)
            empty = low == 0xFFFFFFFF
        out[:, p] = low
    return out.reshape(n, PASSES * BINS)


def fingerprint(texts: list[str], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Block values (texts x BLOCKS, int32) and bit sketches (int64) of the texts."""
    sym = symbols(texts, shingle)
    weights = mix(np.arange(1, BLOCK + 1, dtype=np.uint64)) | np.uint64(1)
    blocks = mix((sym.reshape(len(texts), BLOCKS, BLOCK).astype(np.uint64) * weights).sum(axis=2, dtype=np.uint64))
    bits = (mix(sym[:, :: PASSES * BINS // SKETCH_BITS][:, :SKETCH_BITS].astype(np.uint64)) >> np.uint64(17)) & np.uint64(1)
    sketch = (bits << np.arange(bits.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return (blocks >> np.uint64(32)).astype(np.uint32).view(np.int32), sketch.view(np.int64)


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            texts = whole.column("text").to_pylist()
            for at, stop in text_slices(texts):
                batch = whole.slice(at, stop - at)
                blocks, sketch = fingerprint(texts[at:stop], shingle)
                ends = pa.array(np.arange(0, blocks.size + 1, BLOCKS, dtype=np.int32))
                lists = pa.ListArray.from_arrays(ends, pa.array(blocks.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("srch", "rec", "k1", "k2")), pa.array(sketch), lists], schema=_FP)

    return run


def _verified(shingle: int, threshold: float):
    def shingles(text: str) -> set[str]:
        return {text[k : k + shingle] for k in range(len(text) - shingle + 1)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = []
            last, left = None, set()
            for a, b in zip(pdf["text_a"], pdf["text_b"], strict=True):
                if a != last:
                    last, left = a, shingles(a)
                right = shingles(b)
                both = len(left & right)
                keep.append(both >= threshold * (len(left) + len(right) - both))
            yield pdf.loc[keep, ["srch", "a", "b"]]

    return run


def _shingle_hashes(shingle: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            hashes, owner = window_hashes(*code_points(pdf["text"].tolist()), shingle)
            own = [np.unique(part).view(np.int64) for part in np.split(hashes, np.searchsorted(owner, np.arange(1, len(pdf))))] if len(pdf) else []
            yield pd.DataFrame({"srch": pdf["srch"].to_numpy(), "rep": pdf["rec"].to_numpy(), "n": [len(x) for x in own], "hashes": own})

    return run


def _close(met: DataFrame) -> DataFrame:
    """Pairs (srch, a, b) of a join of blocks whose sketches are close enough for the blocks that they share."""
    distance = F.bit_count(F.col("sketch").bitwiseXOR(F.col("sketch2")))
    near = met.where((F.col("srch") == F.col("srch2")) & (distance <= MAX_SKETCH_DISTANCE))
    a, b = F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")
    pairs = near.groupBy("srch", a, b).agg(F.count("*").alias("shared"), F.min(distance).alias("distance"))
    return pairs.where((F.col("shared") > 1) | (F.col("distance") <= MAX_LONE_DISTANCE)).select("srch", "a", "b")


def _node(column: str) -> Column:
    return F.concat(F.col("srch").cast("string"), F.lit(":"), F.lpad(F.col(column).cast("string"), 20, "0"))


class NearDuplicates:
    """The near-duplicate links of ``records`` (src string, rec long, text string).

    Texts are compared within a ``src``, with all white space dropped. Records with a null src, rec or text,
    or with fewer than ``min_chars`` characters then, have no link. Exact copies are linked to each other.
    A repeated (src, rec) with the same text counts once. Empty tables give no rows.
    The blocks are made for a ``threshold`` of 0.7 or more; a lower one is an error, unless ``exact``, which loses
    no link at any threshold and costs more.
    """

    def __init__(self, records: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD, min_chars: int = MIN_CHARS, exact: bool = False):
        plain = F.regexp_replace("text", WHITE, "")
        rows = (
            records.select(F.col("src").cast("string").alias("src"), F.col("rec").cast("long").alias("rec"), plain.alias("text"))
            .where(F.col("src").isNotNull() & F.col("rec").isNotNull() & (F.length("text") >= max(min_chars, shingle)))
        )
        self._rows = rows.select(
            "src", F.hash("src").alias("srch"), "rec", "text",
            F.xxhash64(F.lit(1), "text").alias("k1"), F.xxhash64(F.lit(2), "text").alias("k2"),
        )
        self._exact = exact
        if threshold < THRESHOLD and not exact:
            raise ValueError(f"threshold {threshold} is below {THRESHOLD}, for which the blocks and sketches are made")
        self._shingle, self._threshold = shingle, threshold
        fp = self._rows.select("srch", "rec", "k1", "k2", "text").mapInArrow(_fingerprints(shingle), _FP_DDL)
        self.texts = write_out(
            fp.groupBy("srch", "k1", "k2")
            .agg(F.min(F.struct("rec", "sketch", "blocks")).alias("x"), F.count("*").alias("copies"))
            .select("srch", "k1", "k2", F.col("x.rec").alias("rep"), "copies", F.col("x.sketch").alias("sketch"), F.col("x.blocks").alias("blocks"))
        )

    @functools.cached_property
    def links(self) -> DataFrame:
        """All links between different texts, (srch, a, b) by representatives."""
        if self._exact:
            return write_out(self._verify(self._sharing_rare_shingles()))
        one = self._blocks()
        two = one.toDF("key2", "srch2", "rep2", "sketch2")
        return write_out(self._verify(_close(one.join(two, (F.col("key") == F.col("key2")) & (F.col("rep") < F.col("rep2"))))))

    def _blocks(self, texts: DataFrame | None = None, *more: str) -> DataFrame:
        rows = self.texts if texts is None else texts
        return rows.select("srch", "rep", "sketch", *more, F.posexplode("blocks").alias("at", "block")).select(
            (F.xxhash64("srch", "at").bitwiseXOR(F.col("block").cast("long"))).alias("key"), "srch", "rep", "sketch", *more
        )

    def _sharing_rare_shingles(self) -> DataFrame:
        """Pairs (srch, a, b) of texts that share one of the first shingles of both, the rarest coming first.

        Of two sets of n and m shingles that are similar enough, all but the first n - ceil(threshold * n) + 1 of
        either cannot hold all that they share.
        """
        chosen = self._rows.join(self.texts.select("srch", F.col("rep").alias("rec")), ["srch", "rec"]).dropDuplicates(["srch", "rec"])
        sets = write_out(chosen.select("srch", "rec", "text").mapInPandas(_shingle_hashes(self._shingle), "srch int, rep long, n int, hashes array<long>"))
        flat = sets.select("srch", "rep", "n", F.explode("hashes").alias("h"))
        common = flat.groupBy("srch", "h").agg(F.count("*").alias("uses"))
        rank = F.row_number().over(Window.partitionBy("srch", "rep").orderBy("uses", "h"))  # a text's own shingles
        first = flat.join(common, ["srch", "h"]).withColumn("rank", rank).where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * self._threshold - 1e-9) + 1)
        one = write_out(first.select("srch", "h", "rep", "n"))
        two = one.toDF("srch", "h", "rep2", "n2")
        near = (F.col("rep") < F.col("rep2")) & (F.col("n") >= self._threshold * F.col("n2") - 1e-9) & (F.col("n2") >= self._threshold * F.col("n") - 1e-9)
        return one.join(two, ["srch", "h"]).where(near).select("srch", F.col("rep").alias("a"), F.col("rep2").alias("b")).distinct()

    def _verify(self, candidates: DataFrame) -> DataFrame:
        """The candidate pairs (srch, a, b) of representatives whose texts are similar enough."""
        found = write_out(candidates)
        slot = F.pmod(F.xxhash64("srch", "rec"), F.lit(SLOTS))
        needed = found.select("srch", F.explode(F.array("a", "b")).alias("rec")).select(slot.alias("slot"))
        words = needed.groupBy(F.shiftright("slot", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, CAST(slot % 64 AS INT))) AS bits"))
        bitmap = np.zeros(SLOTS // 64, np.uint64)
        for r in words.collect():  # at most SLOTS / 64 rows
            bitmap[r.w] = np.uint64(r.bits & 0xFFFFFFFFFFFFFFFF)

        @F.pandas_udf("boolean")
        def wanted(s: pd.Series) -> pd.Series:
            at = s.to_numpy(np.int64)
            return pd.Series((bitmap[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0)

        texts = self._rows.select("srch", "rec", "text", slot.alias("slot")).where(wanted("slot")).select("srch", "rec", "text")
        both = found.join(texts.toDF("srch", "a", "text_a"), ["srch", "a"]).join(texts.toDF("srch", "b", "text_b"), ["srch", "b"])
        return both.select("srch", "a", "b", "text_a", "text_b").mapInPandas(_verified(self._shingle, self._threshold), "srch int, a long, b long").distinct()

    def _members(self) -> DataFrame:
        return self._rows.select("src", "srch", "k1", "k2", "rec").join(self.texts.select("srch", "k1", "k2", "rep", "copies"), ["srch", "k1", "k2"])

    def pairs(self) -> DataFrame:
        """All linked pairs of records: (src, rec_a, rec_b), rec_a < rec_b."""
        own = self.texts.where("copies > 1").select("srch", F.col("rep").alias("a"), F.col("rep").alias("b"))
        links = self.links.union(own)
        m = self._members().select("src", "srch", "rep", "rec")
        ma = m.select("src", "srch", F.col("rep").alias("a"), F.col("rec").alias("ra"))
        mb = m.select("srch", F.col("rep").alias("b"), F.col("rec").alias("rb"))
        out = links.join(ma, ["srch", "a"]).join(mb, ["srch", "b"]).where("a <> b or ra < rb")
        return out.select("src", F.least("ra", "rb").alias("rec_a"), F.greatest("ra", "rb").alias("rec_b")).where("rec_a < rec_b").distinct()

    def labels(self) -> DataFrame:
        """(srch, rep, label, linked): the component of each text, found without all pairs of a block.

        Every text is held against the first of each of its blocks; only blocks in which texts of different
        components are left are then joined, across components, whose labels are joined in turn. A large group
        whose texts resemble their first costs as many pairs as it has texts and blocks. Not for the exact mode.
        """
        one = self._blocks()
        head = one.groupBy("key").agg(F.min(F.struct("rep", "srch", "sketch")).alias("h"))
        heads = head.select(F.col("key").alias("key2"), F.col("h.srch").alias("srch2"), F.col("h.rep").alias("rep2"), F.col("h.sketch").alias("sketch2"))
        star = self._verify(_close(one.join(heads, (F.col("key") == F.col("key2")) & (F.col("rep") != F.col("rep2")))))
        labelled = write_out(self._labelled(star))
        # labelled by text, before the blocks are unfolded
        rows = self._blocks(self.texts.join(labelled.select("srch", "rep", F.xxhash64("label").alias("comp")), ["srch", "rep"]), "comp")
        mixed = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
        left = write_out(rows.join(mixed, "key").select("key", "srch", "rep", "sketch", "comp"))
        right = left.toDF("key2", "srch2", "rep2", "sketch2", "comp2")
        across = self._verify(_close(left.join(right, (F.col("key") == F.col("key2")) & (F.col("rep") < F.col("rep2")) & (F.col("comp") != F.col("comp2")))))
        named = labelled.select("srch", "rep", "label")
        ends = across.join(named.toDF("srch", "a", "la"), ["srch", "a"]).join(named.toDF("srch", "b", "lb"), ["srch", "b"])
        roots = components(ends.select(F.col("la").alias("a"), F.col("lb").alias("b"))).toDF("label", "root")
        return labelled.join(roots, "label", "left").select("srch", "rep", F.coalesce("root", "label").alias("label"), (F.col("linked") | F.col("root").isNotNull()).alias("linked"))

    def _labelled(self, links: DataFrame) -> DataFrame:
        """(srch, rep, label, linked) of all texts by the components of links; a text without one is its own."""
        found = components(links.select(_node("a").alias("a"), _node("b").alias("b")))
        known = self.texts.select("srch", "rep", _node("rep").alias("node")).join(found, "node", "left")
        return known.select("srch", "rep", F.coalesce("component", "node").alias("label"), F.col("component").isNotNull().alias("linked"))

    def _grouped(self, labels: DataFrame) -> DataFrame:
        """(src, srch, rec, rep, copies, group_id) of every record of a link or of a text with copies."""
        members = self._members().select("src", "srch", "rep", "rec").distinct()
        copies = members.groupBy("srch", "rep").agg(F.count("*").alias("copies"))
        rows = members.join(copies, ["srch", "rep"]).join(labels, ["srch", "rep"])
        group = F.split("label", ":")[1].cast("long").alias("group_id")
        return rows.where("copies > 1 or linked").select("src", "srch", "rec", "rep", "copies", group)

    def groups(self) -> DataFrame:
        """One row per linked record: (src, rec, group_id); group_id is the group's smallest rec."""
        labels = self._labelled(self.links) if self._exact else self.labels()
        return self._grouped(labels).select("src", "rec", "group_id")

    def link_counts(self) -> DataFrame:
        """As :meth:`groups`, with n_links: the number of records, copies included, that a record is linked to."""
        rows = write_out(self._grouped(self._labelled(self.links)))
        copies = rows.select("srch", F.col("rep").alias("b"), "copies").distinct()
        both = self.links.union(self.links.select("srch", F.col("b").alias("a"), F.col("a").alias("b")))
        beside = both.join(copies, ["srch", "b"]).groupBy("srch", F.col("a").alias("rep")).agg(F.sum("copies").alias("beside"))
        counted = rows.join(beside, ["srch", "rep"], "left")
        return counted.select("src", "rec", "group_id", (F.coalesce("beside", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
