"""Repetition inside a single document, judged by weak supervision.

Rules on repeated content vote repeated, clean or abstain, none of them by the share that is measured;
expectation-maximisation over the counts of the vote patterns estimates how often each rule is right; a
document's posterior replaces the all-must-pass filtering. The patterns are few (3 to the number of rules), whatever the number of documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliplake.llm.chars import code_points, distinct_counts, text_slices, window_hashes
from cliplake.session import write_out

RULES = ("short", "long", "sentences", "run", "top")
MIN_CHARS = 40
#: Characters of the windows whose repeated share is measured, and of those that the rules look at.
WIDTH, SHORT, LONG = 8, 6, 20
_ENDS = re.compile(r"[。！？!?；;\n]+|\.(?=\s|$)")
_RUN = re.compile(r"(.)\1{11,}", re.S)
_SCHEMA = "rec long, n_chars long, repeat_share double, sentence_share double, short int, long int, sentences int, run int, top int"


def sentence_share(text: str) -> tuple[float, int]:
    """Share of a text's sentence characters that lie in sentences seen before in it; number of sentences."""
    seen: set[str] = set()
    total = again = n = 0
    for raw in _ENDS.split(text):
        sentence = "".join(raw.split())
        if sentence:
            n += 1
            total += len(sentence)
            if sentence in seen:
                again += len(sentence)
            seen.add(sentence)
    return (again / total if total else 0.0), n


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        texts = [t or "" for t in whole.column("text").to_pylist()]
        for at, stop in text_slices(texts):
            batch, raw = whole.slice(at, stop - at), texts[at:stop]
            dense = ["".join(t.split()) for t in raw]
            flat, offsets = code_points(dense)
            n = np.diff(offsets)
            shares = {}
            for width in (WIDTH, SHORT, LONG):
                hashes, owner = window_hashes(flat, offsets, width)
                distinct, most = distinct_counts(hashes, owner, len(raw))
                windows = np.maximum(n - width + 1, 1)
                shares[width] = np.where(n >= width, 1 - distinct / windows, 0.0)
                if width == SHORT:
                    top = most * width / np.maximum(n, 1)
            by_sentence = [sentence_share(t) for t in raw]
            again = np.array([s for s, _ in by_sentence])
            count = np.array([k for _, k in by_sentence])
            run = np.array([_RUN.search(t) is not None for t in dense])
            # weak signals, none of which is the measured share: phrases, long passages, sentences, runs, one phrase
            votes = [
                np.where(shares[SHORT] >= 0.27, 1, np.where(shares[SHORT] <= 0.18, -1, 0)),
                np.where(shares[LONG] >= 0.12, 1, np.where(shares[LONG] <= 0.05, -1, 0)),
                np.where((count > 1) & (again >= 0.2), 1, np.where((count > 2) & (again == 0), -1, 0)),
                np.where(run, 1, 0),
                np.where(top >= 0.1, 1, np.where(top <= 0.04, -1, 0)),
            ]
            long_enough = n >= MIN_CHARS
            cols = [batch.column("rec"), pa.array(n), pa.array(shares[WIDTH]), pa.array(again)]
            cols += [pa.array(np.where(long_enough, v, 0).astype(np.int32)) for v in votes]
            yield pa.RecordBatch.from_arrays(cols, names=["rec", "n_chars", "repeat_share", "sentence_share", *RULES])


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """EM for the posterior of each vote pattern (patterns x rules in -1, 0, 1) being repeated.

    An abstention says nothing. Rules start out better than chance, which fixes the meaning of the classes.
    """
    yes, no = (patterns == 1).astype(float), (patterns == -1).astype(float)
    prior = 0.1
    hit = np.full(patterns.shape[1], 0.8)  # P(votes repeated | repeated, votes)
    false = np.full(patterns.shape[1], 0.05)  # P(votes repeated | clean, votes)
    post = np.full(len(patterns), prior)
    for _ in range(rounds):
        log = np.log(prior / (1 - prior)) + yes @ np.log(hit / false) + no @ np.log((1 - hit) / (1 - false))
        new = 1 / (1 + np.exp(-np.clip(log, -50, 50)))
        w = counts * new
        hit = np.clip((yes.T @ w + 8) / ((yes + no).T @ w + 10), 0.55, 0.999)
        v = counts * (1 - new)
        false = np.clip((yes.T @ v + 0.5) / ((yes + no).T @ v + 10), 0.001, 0.45)
        prior = float(np.clip(w.sum() / max(counts.sum(), 1), 1e-4, 0.9))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return post


def repetition(documents: DataFrame, rec: str, text: str) -> DataFrame:
    """(rec, n_chars, repeat_share, sentence_share, the votes, posterior) of every record.

    ``repeat_share`` is the share of windows of 8 characters, white space dropped, that occurred before in
    the text; ``posterior`` is the probability that the text is repetitive. A null, blank or short text has
    no vote and gets the prior. Records are kept as they come: repeated ids stay repeated, a null id stays.
    An empty table gives no rows; other columns are not read.
    """
    rows = documents.select(F.col(rec).cast("long").alias("rec"), F.col(text).cast("string").alias("text"))
    voted = write_out(rows.mapInArrow(_votes, _SCHEMA))
    patterns = voted.groupBy(*RULES).count().collect()  # at most 3 ** len(RULES) rows
    if not patterns:
        return voted.withColumn("posterior", F.lit(None).cast("double"))
    votes = np.array([[r[c] for c in RULES] for r in patterns], dtype=int)
    post = fit_votes(votes, np.array([r["count"] for r in patterns], dtype=float))
    table = documents.sparkSession.createDataFrame(
        [(*map(int, v), float(p)) for v, p in zip(votes, post, strict=True)], ", ".join(f"{c} int" for c in RULES) + ", posterior double"
    )
    return voted.join(F.broadcast(table), list(RULES)).select(
        "rec", "n_chars", "repeat_share", "sentence_share", *RULES, "posterior"
    )
