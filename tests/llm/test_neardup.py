import random
from collections import Counter

import numpy as np
import pytest

from cliplake.llm.neardup import NearDuplicates, fingerprint, symbols
from cliplake.llm.repetition import fit_votes, repetition, sentence_share

WORDS = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "zen", "tur") for b in ("ra", "ne", "so", "vik") for c in ("n", "s", "t", "x", "")]
DDL = "src string, rec long, text string, key long, slot long"


def edited(rng, text, share):
    words = text.split(" ")
    for _ in range(max(1, int(len(words) * share))):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


def pairs(rows, threshold=0.7):
    kept = []
    for src, rec, text in {(s, r, t) for s, r, t in rows if None not in (s, r, t)}:
        t = "".join(text.split())
        if len(t) >= 40:
            kept.append((src, rec, {t[k : k + 3] for k in range(len(t) - 2)}))
    out = set()
    for i, (s, a, x) in enumerate(kept):
        for s2, b, y in kept[:i]:
            if s == s2 and a != b and len(x & y) >= threshold * len(x | y):
                out.add((s, min(a, b), max(a, b)))
    return out


def collection(seed):
    rng = random.Random(seed)
    rows = []
    for k in range(60):
        base = " ".join(rng.choice(WORDS) for _ in range(60))
        rows += [("clip", 10 * k, base), ("clip", 10 * k + 1, edited(rng, base, 0.05)), ("clip", 10 * k + 2, edited(rng, base, 0.1)), ("pair", 10 * k, base)]
    same = " ".join(rng.choice(WORDS) for _ in range(40))
    rows += [("clip", 5000 + k, same if k % 2 else same.replace(" ", "　")) for k in range(30)]  # a third of a source may be one text
    rows += [("pair", 7000, None), ("pair", 7001, ""), ("pair", 7002, "short"), (None, 7003, same), ("pair", None, same), ("clip", 5000, same.replace(" ", "　"))]
    rows += [("pair", 7004, "x" * 50_000), ("pair", 7005, "x" * 49_000), ("pair", 7006, "短" * 40), ("pair", 7007, "短" * 41)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_equal_brute_force(spark, seed):
    rows = collection(seed)
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], DDL)
    found = NearDuplicates(df)
    got = [tuple(r) for r in found.pairs().collect()]
    wanted = pairs(rows)
    assert len(got) == len(set(got)) and set(got) == wanted
    degree, parent = Counter(), {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for s, a, b in wanted:
        degree[s, a] += 1
        degree[s, b] += 1
        x, y = find((s, a)), find((s, b))
        parent[max(x, y)] = min(x, y)
    counts = {(r.src, r.rec): r for r in found.link_counts().collect()}
    assert {k: r.n_links for k, r in counts.items()} == dict(degree)
    groups = {(r.src, r.rec): r.group_id for r in found.groups().collect()}
    assert groups == {k: find(k)[1] for k in parent} == {k: r.group_id for k, r in counts.items()}


def test_dense_group_of_different_texts(spark):
    rng = random.Random(9)
    base = " ".join(rng.choice(WORDS) for _ in range(80))
    rows = [("clip", k, base + f" {k:04d}", 0, 0) for k in range(400)] + [("clip", 1000 + k, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(400)), 0, 0) for k in range(50)]
    found = NearDuplicates(spark.createDataFrame(rows, DDL))
    met, verify = [], found._verify

    def spy(candidates):
        rows = candidates.cache()
        met.append(rows.count())
        return verify(rows)

    found._verify = spy
    groups = {r.rec: r.group_id for r in found.groups().collect()}
    assert groups == {k: 0 for k in range(400)}
    assert sum(met) < 400 * 40  # texts times blocks, of 80,000 pairs


@pytest.mark.parametrize("threshold", [0.7, 0.5])
def test_the_exact_mode_loses_no_link(spark, threshold):
    rows = collection(3)
    rng = random.Random(4)
    for k in range(25):
        base = " ".join(rng.choice(WORDS) for _ in range(12))
        rows += [("pair", 8000 + 10 * k + j, edited(rng, base, 0.04 * j)) for j in range(6)]
    found = NearDuplicates(spark.createDataFrame([(*r, 1, 2) for r in rows], DDL), threshold=threshold, exact=True)
    wanted = pairs(rows, threshold)
    assert {tuple(r) for r in found.pairs().collect()} == wanted and wanted > pairs(rows, 0.8)
    assert {(r.src, r.rec) for r in found.groups().collect()} == {(s, x) for s, a, b in wanted for x in (a, b)}


def test_empty_table(spark):
    found = NearDuplicates(spark.createDataFrame([], DDL))
    assert found.pairs().count() == 0 and found.groups().count() == 0 and found.link_counts().count() == 0


def test_recall_at_the_threshold():
    rng = random.Random(8)
    base = [" ".join(rng.choice(WORDS) for _ in range(60)).replace(" ", "") for _ in range(300)]
    near = []
    for t in base:
        cut = int(len(t) * 0.065)
        near.append("".join(rng.choice("abcdefgh") for _ in range(cut)) + t[cut : len(t) - cut] + "".join(rng.choice("abcdefgh") for _ in range(cut)))
    a, b = fingerprint(base)[0], fingerprint(near)[0]
    sets = [[{x[k : k + 3] for k in range(len(x) - 2)} for x in side] for side in (base, near)]
    close = np.array([len(x & y) / len(x | y) for x, y in zip(*sets, strict=True)])
    met = (a == b).any(axis=1)
    assert 0.7 < close.mean() < 0.8 and met[close >= 0.7].mean() > 0.98


def test_symbols_depend_on_the_shingle_set_only():
    a, b = symbols(["abcabcabcabc", "abcabcabcabcabcabc"])
    assert (a == b).all() and (symbols(["abcdefgh" * 10]) != symbols(["hgfedcba" * 10])).any()


REP = "row_id long, description string, wide int, posterior double"


def share(text):
    t = "".join((text or "").split())
    return 1 - len({t[k : k + 8] for k in range(len(t) - 7)}) / (len(t) - 7) if len(t) >= 40 else 0.0


def test_repetition_shares_and_posterior(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(WORDS) for _ in range(50)) + "." for _ in range(200)]
    for k in range(0, 200, 9):
        texts[k] = ("。".join([texts[k][:60]] * 6)) if k % 2 else texts[k] + "快" * 80
    texts += [None, "", "　", "短", "ab" * 30_000, texts[0]]
    df = spark.createDataFrame([(k, t, 0, 0.5) for k, t in enumerate(texts)] + [(None, texts[1], 0, 0.5)], REP)
    rows = repetition(df, "row_id", "description").collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        if r.rec is not None:
            assert abs(r.repeat_share - share(texts[r.rec])) < 1e-12 or r.n_chars < 40
            if r.n_chars >= 40:
                assert r.posterior >= 0.5 or r.repeat_share < 0.3, (r, texts[r.rec][:60])
    clean = [r.posterior for r in rows if r.n_chars >= 40 and r.repeat_share < 0.15]
    again = [r.posterior for r in rows if r.repeat_share >= 0.25]
    assert np.mean(clean) < 0.2 and np.mean(again) > 0.95
    assert repetition(df.where("false"), "row_id", "description").count() == 0


def test_sentence_share_and_votes():
    assert sentence_share("走。走。打！") == (pytest.approx(1 / 3), 3) and sentence_share("") == (0.0, 0)
    post = fit_votes(np.array([[1, 1, 1, 1, 1], [1, 0, 0, 0, 0], [-1, -1, -1, 0, 0], [0, 0, 0, 0, 0]]), np.array([30.0, 5, 900, 20]))
    assert post[0] > 0.99 and post[1] > 0.5 and post[2] < 0.01


def test_threshold_below_what_the_blocks_are_made_for(spark):
    with pytest.raises(ValueError):
        NearDuplicates(spark.createDataFrame([], DDL), threshold=0.5)
    assert NearDuplicates(spark.createDataFrame([], DDL), threshold=0.5, exact=True).pairs().count() == 0
