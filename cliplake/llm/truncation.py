"""Texts cut off by field limits: hashed logistic regression trained on artificial cuts.

A source's limits are the lengths, in characters or bytes, at which its open-ended values pile up. Intact
values (ending in a sentence mark) of a bounded sample are cut, at the limits found and elsewhere inside a
sentence, to make positives; the same values, with and without their last mark, are the negatives. The model
sees the closing characters, the punctuation and the length against the limits, and scores every record.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliplake.session import table_partitions, write_out

#: Bound of the training sample, in rows: the driver fits the model on at most these.
SAMPLE_ROWS = 6_000
#: A length is a limit if its open-ended values exceed those of the lengths around by so many standard deviations.
PILE_SIGMAS = 6.0
PILE_AROUND, PILE_GAP = 15, 3
CUT_LIMITS = 1_000  # training cuts are made at no more limits than these, the most frequent
#: Sources with a limit up to which their table is broadcast; more are joined by salted keys.
MAX_BROADCAST = 50_000
SALTS = 32
BITS = 20
MARKS = "。．.!！?？…‥"
_CLOSERS = "”\"’'）)」』】》〉]］}｝*_~～`"
_OMISSION = re.compile(r"(?:…+|‥+|\.{3,}|。{3,}|·{3,}|⋯+|—{2,}|\[(?:…|\.\.\.)\]|（(?:…|\.\.\.)）|\(\.\.\.\))\s*$")
_OMITTING = tuple("…‥.。·⋯—])）")
_TAG = re.compile(r"(?:\s*[#＃@][\w·-]+)+\s*$")
_LATIN = re.compile(r"[A-Za-zÀ-ɏ][A-Za-zÀ-ɏ_]*")
_NAME = re.compile(r"\b[A-Z][a-z]{3,}[a-z_]*\d*\b")
_DIGITS = re.compile(r"\d+")
_SENTENCE_END = re.compile(r"[。！？!?]+|\.(?=\s|$)")
RAW_GRAMS = (1, 2, 3, 4, 5, 6, 8, 10, 12)
MASKED_GRAMS = (2, 3, 4, 6, 8, 10, 12, 16, 20, 26)


def strip_wrapping(text: str) -> tuple[str, bool, str]:
    """A text without trailing emoji, hashtags, closing quotes and omission marks.

    Returns the rest, whether an omission mark was there, and the kind of ending: "mark", "broken" (a
    replacement character) or "open".
    """
    t = text.rstrip()
    omitted = False
    while True:
        before = t
        if "#" in t or "＃" in t or "@" in t:
            t = _TAG.sub("", t).rstrip()
        while t and not t[-1].isalnum() and (t[-1] in _CLOSERS or unicodedata.category(t[-1]) in ("So", "Sk", "Mn", "Cf", "Cs") and t[-1] != "�"):
            t = t[:-1].rstrip()
        if t[-1:] in _OMITTING and (cut := _OMISSION.sub("", t)) != t:
            t, omitted = cut.rstrip(), True
        if t == before:
            break
    if t.endswith("�"):
        return t.rstrip("�"), omitted, "broken"
    return t, omitted, "mark" if t and t[-1] in MARKS and not omitted else "open"


def _mask(tail: str) -> str:
    return _DIGITS.sub("0", _NAME.sub("N", tail))


def features(text: str, at_limit: int) -> list[int]:
    """Hashed feature numbers of a text; ``at_limit`` is its :func:`nearness` to its source's limits."""
    rest, omitted, ending = strip_wrapping(text)
    names = [f"e{ending}", f"l{at_limit}", f"o{int(omitted)}", f"e{ending}l{at_limit}"]
    if ending != "mark":
        names.append(f"t{int(text[-1:].isspace())}{int(omitted)}")
        tail = rest[-60:]
        last = _SENTENCE_END.split(tail)[-1]
        masked = _mask(last)
        names += [f"r{n}:{tail[-n:]}" for n in RAW_GRAMS if len(tail) >= n]
        names += [f"m{n}:{masked[-n:]}" for n in MASKED_GRAMS if len(masked) >= n]
        names.append(f"w:{masked}")
        word = last.rsplit(" ", 1)[-1][-20:]
        names.append(f"s:{word.lower()}")
        pair = " ".join(masked.lower().split()[-2:])[-30:]
        names.append(f"p:{pair}")
        names.append(f"n{min(len(last), 6)}")
        for a, b in ("（）", "()", "“”", "《》", "【】"):
            if rest.count(a) > rest.count(b) and not (rest[:1] == a):
                names.append(f"d{a}")
    mask = (1 << BITS) - 1
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) & mask for x in names]


def nearness(text: str, chars: Sequence[int], octets: Sequence[int]) -> int:
    """2 for a text as long as one of the limits, 1 for one that is up to 3 short of it, else 0."""
    n, size = len(text), len(text.encode("utf-8", "surrogatepass"))
    if n in chars or size in octets:
        return 2
    return int(any(0 < x - n <= 3 for x in chars) or any(0 < x - size <= 3 for x in octets))


def cut_at(text: str, unit: str, limit: int) -> str | None:
    """The text cut at a limit of characters ("c") or bytes ("b"); None if it is no longer than that."""
    if unit == "c":
        return text[:limit] if len(text) > limit else None
    raw = text.encode("utf-8", "surrogatepass")
    return raw[:limit].decode("utf-8", "replace") if len(raw) > limit else None


def make_examples(
    texts: list[str], seed: int = 7, cuts: int = 10, bare_is_whole: bool = True, own: list[int] | None = None, limits: Sequence[tuple[str, int, float]] = (), limited: float = 0.0
) -> list[tuple[str, int, float]]:
    """(text, nearness, label) examples from intact texts: cuts inside sentences, and whole endings.

    ``limits`` are the (unit, length, number of values) found; a cut is made at one of them, drawn by their
    numbers, with the probability ``limited``, else anywhere inside a sentence. ``own`` is each text's
    nearness to its own source's limits. A sentence without its mark is whole if ``bare_is_whole``, else one
    more cut.
    """
    weight = np.array([n for *_, n in limits], float)
    chars, octets = ({x for u, x, _ in limits if u == unit} for unit in "cb")
    out: list[tuple[str, int, float]] = []
    for k, text in enumerate(texts):
        _, _, ending = strip_wrapping(text)
        ends = [m.end() for m in _SENTENCE_END.finditer(text)]
        if ending != "mark" or not ends:
            continue
        spans = [(a, b) for a, b in zip([0, *ends], ends, strict=False) if b - a > 6]
        if not spans:
            continue
        near = own[k] if own else 0
        rng = np.random.default_rng([seed, zlib.crc32(text.encode("utf-8", "surrogatepass"))])  # the text's own draws
        for turn in range(cuts):
            piece = None
            if len(limits) and rng.random() < limited:
                unit, limit, _ = limits[int(rng.choice(len(limits), p=weight / weight.sum()))]
                piece = cut_at(text, unit, limit)
                if piece is not None and strip_wrapping(piece)[2] != "mark":
                    out.append((piece, nearness(piece, chars, octets), 1.0))
            a, b = spans[int(rng.integers(len(spans)))]
            whole = text[:b].rstrip()
            bare = whole.rstrip("".join(MARKS))
            at = int(rng.integers(a + 1, len(bare))) if len(bare) > a + 1 else 0
            if piece is None and at > a and text[a:at].strip() and at < len(bare):
                piece = text[:at]
                style = rng.random()
                if style < 0.25:
                    piece += "…" if style < 0.15 else "..."
                elif style < 0.32:
                    piece += "�"
                out.append((piece, 0, 1.0))
            last = b == ends[-1]
            spaced = bare + " " if rng.random() < 0.005 else bare
            out.append((spaced, near if last else 0, 0.0 if bare_is_whole else 1.0))
            if turn < 2:
                out.append((whole, near if last else 0, 0.0))
    return out


def fit(examples: list[tuple[str, int, float]], epochs: int = 4, rate: float = 0.3, seed: int = 11) -> np.ndarray:
    """Weights of the hashed logistic regression (AdaGrad over mini-batches)."""
    return fit_slots([np.array(features(t, k), np.int64) for t, k, _ in examples], np.array([y for *_, y in examples]), epochs, rate, seed)


def fit_slots(rows: list[np.ndarray], labels: np.ndarray, epochs: int = 4, rate: float = 0.3, seed: int = 11) -> np.ndarray:
    """As :func:`fit`, of examples given by their feature numbers."""
    weights = np.zeros(1 << BITS, np.float64)
    if not rows:
        return weights.astype(np.float32)
    power = np.full(1 << BITS, 1e-8)
    rng = np.random.default_rng(seed)
    size = 64
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), size):
            take = order[at : at + size]
            index = np.concatenate([rows[i] for i in take])
            count = np.array([len(rows[i]) for i in take])
            start = np.concatenate([[0], np.cumsum(count)[:-1]])
            score = np.add.reduceat(weights[index], start)
            gap = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels[take]
            slots, inverse = np.unique(index, return_inverse=True)
            step = np.bincount(inverse, np.repeat(gap, count), len(slots)) + 1e-4 * weights[slots]
            power[slots] += step * step
            weights[slots] -= rate * step / np.sqrt(power[slots])
    return weights.astype(np.float32)


def fit_sample(sample: DataFrame, examples: Callable[[str, int], list[tuple[str, int, float]]]) -> np.ndarray:
    """Weights fitted on ``examples`` of each row (place, text, near) of a bounded sample.

    The examples and their features are made in the tasks; the driver gets their numbers only.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [(place, k, y, features(t, n)) for place, text, near in zip(pdf["place"], pdf["text"], pdf["near"], strict=True) for k, (t, n, y) in enumerate(examples(text, int(near)))]
            yield pd.DataFrame(made, columns=["place", "k", "label", "slots"])

    spread = sample.select("place", "text", "near").repartition(table_partitions(sample.sparkSession))
    made = spread.mapInPandas(run, "place long, k int, label double, slots array<int>").toPandas().sort_values(["place", "k"], kind="stable")
    return fit_slots([np.asarray(x, np.int64) for x in made["slots"]], made["label"].to_numpy())


def probability(weights: np.ndarray, text: str, at_limit: int) -> float:
    score = float(weights[features(text, at_limit)].sum())
    return 1 / (1 + float(np.exp(-min(30.0, max(-30.0, score)))))


def is_placeholder(text: str) -> bool:
    """A bare placeholder: no letter or digit at all, or a lone word for "nothing"."""
    core = "".join(c for c in text if c.isalnum()).lower()
    return core in ("", "na", "null", "none", "无", "暂无", "nan", "todo", "tbd", "placeholder")


def _open_ended() -> Column:
    """Whether a text ends without a sentence mark; a bare placeholder does not count."""
    marked = F.right("text", F.lit(12)).rlike(r"[。．.!！?？…‥][\s\p{So}\p{Sk}\p{Mn}\p{Cf}”\"’'）)」』】》〉\]］}｝*_~～`]*$")
    return F.col("text").rlike(r"[\p{L}\p{N}]") & ~marked


def source_limits(rows: DataFrame) -> DataFrame:
    """(src, source_file, unit, length, n): the limits of every source, by pile-up; ``n`` open-ended values lie there.

    Only lengths are shuffled, counted map-side: one row per source, unit and length.
    """
    sizes = F.array(F.struct(F.lit("c").alias("unit"), F.length("text").alias("length")), F.struct(F.lit("b").alias("unit"), F.octet_length("text").alias("length")))
    counted = rows.where(_open_ended()).select("src", "source_file", F.explode(sizes).alias("x")).groupBy("src", "source_file", "x.unit", "x.length").agg(F.count("*").alias("n"))
    by = Window.partitionBy("src", "source_file", "unit").orderBy("length")
    near = lambda k: F.sum("n").over(by.rangeBetween(-k, k))
    mean = (near(PILE_AROUND) - near(PILE_GAP)) / (2 * (PILE_AROUND - PILE_GAP))
    return counted.withColumn("mean", mean).where((F.col("n") - F.col("mean")) > PILE_SIGMAS * F.sqrt(F.col("mean") + 1)).drop("mean")


def _near(chars: str, octets: str) -> Column:
    """:func:`nearness` as a column, 0 where the source has no limit."""
    n, size = F.length("text"), F.octet_length("text")
    at = F.array_contains(chars, n) | F.array_contains(octets, size)
    short = lambda limits, x: F.exists(limits, lambda y: (y - x).between(1, 3))
    return F.when(at, 2).when(short(chars, n) | short(octets, size), 1).otherwise(0)


def with_nearness(rows: DataFrame, limits: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``rows`` with the column near; ``limits`` as of :func:`source_limits`, written out.

    The texts are shuffled only if there are over ``max_broadcast`` sources with a limit, then by salted keys.
    """
    lists = lambda unit: F.collect_set(F.when(F.col("unit") == unit, F.col("length")))  # noqa: E731 - few lengths pile up
    keyed = write_out(limits.groupBy(F.col("src").alias("lsrc"), F.col("source_file").alias("lfile")).agg(lists("c").alias("chars"), lists("b").alias("octets")))
    same = F.col("src").eqNullSafe(F.col("lsrc")) & F.col("source_file").eqNullSafe(F.col("lfile"))
    if keyed.count() <= max_broadcast:
        joined = rows.join(F.broadcast(keyed), same, "left")
    else:
        spread = keyed.withColumn("lsalt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("rec", "text"), F.lit(SALTS)).cast("int")
        joined = rows.withColumn("salt", salt).join(spread, same & (F.col("salt") == F.col("lsalt")), "left")
    return joined.select(*rows.columns, _near("chars", "octets").alias("near"))


def truncated(records: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(src, rec, source_file, probability) of each non-blank record of (src, rec, text, source_file).

    Limits are found per src and source_file over all records; records without source_file are one source.
    Null and blank texts and bare placeholders get no row. Repeated records are scored each. With no intact
    value in the sample every probability is 0.5. An empty table gives no rows; other columns are not read.
    """
    spark = records.sparkSession
    rows = records.select(
        F.col("src").cast("string").alias("src"), F.col("rec").cast("long").alias("rec"), F.col("text").cast("string").alias("text"),
        F.col("source_file").cast("string").alias("source_file"),
    ).where(F.col("text").rlike(r"(?U)[^\s\x1c-\x1f]"))
    limits = write_out(source_limits(rows))
    near = with_nearness(rows, limits)
    opened = _open_ended()
    total, n_open, n_at = near.agg(F.count("*"), F.count_if(opened), F.count_if(opened & (F.col("near") == 2))).first()
    limited = n_at / max(n_open, 1)  # how many of the open ends lie at a limit
    share = min(1.0, 2 * sample_rows / max(total, 1))
    placed = near.select("src", "rec", "text", "near", F.xxhash64("src", "rec").alias("place"))
    picked = placed.where(F.pmod("place", F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    # in hash order, so that every source and file has its share of the sample
    sample = picked.orderBy("place", "src", "rec", "text").limit(sample_rows)
    common = limits.groupBy("unit", "length").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "unit", "length").limit(CUT_LIMITS)
    found = [(r.unit, r.length, r.n) for r in common.collect()]
    weights = fit_sample(sample, lambda text, k: make_examples([text], own=[k], limits=found, limited=limited))
    shared = spark.sparkContext.broadcast(weights)  # 4 MB, fixed by BITS

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = shared.value
        for pdf in batches:
            keep = [not is_placeholder(t) for t in pdf["text"]]
            out = pdf.loc[keep, ["src", "rec", "source_file"]]
            yield out.assign(probability=[probability(w, t, int(k)) for t, k, ok in zip(pdf["text"], pdf["near"], keep, strict=True) if ok])

    return near.mapInPandas(score, "src string, rec long, source_file string, probability double")
