import os
import random
from collections import Counter

import numpy as np
import pytest
from checks import tables

from cliplake.llm import language as L
from cliplake.llm import leakage as K
from cliplake.llm import packing as C
from cliplake.llm.chars import code_points, distinct_counts, window_hashes
from cliplake.llm.qadefects import language_votes

DOCS = "doc_id long, text string, lang string, key long, size long, label string"
ITEMS = "item_id long, suite string, text string"
WORDS = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "zen", "tur") for b in ("ra", "ne", "so", "vik") for c in ("n", "s", "t", "x", "")]


def docs(spark, rows):
    return spark.createDataFrame([(k, t, lang, 1, 2, "x") for k, t, lang in rows], DOCS)


def said(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(100)) for _ in range(n))


def test_windows_and_distinct_counts():
    texts = ["abab", "", "x", "aaaa", "中文中文中"]
    hashes, owner = window_hashes(*code_points(texts), 2)
    distinct, most = distinct_counts(hashes, owner, len(texts))
    wanted = [[t[k : k + 2] for k in range(len(t) - 1)] for t in texts]
    assert distinct.tolist() == [len(set(w)) for w in wanted]
    assert most.tolist() == [max([w.count(x) for x in w], default=0) for w in wanted]
    assert window_hashes(*code_points(["", "a"]), 2)[0].size == 0


def leaks(rows, items):
    out = {}
    plain = [(d, K.normalise(text)) for d, text, _ in rows if text is not None and d is not None]
    for i, t in items:
        n = K.normalise(t)
        grams = {n[k : k + 10] for k in range(len(n) - 9)}
        for d, text in plain if grams and i is not None else []:
            share = sum(g in text for g in grams) / len(grams)
            if share >= 0.4:
                out[d, i] = max(share, out.get((d, i), 0))
    return out


def test_leaks_equal_brute_force(spark):
    rng = random.Random(1)
    items = [(k, said(rng, 20 + 15 * (k % 3))) for k in range(12)] + [(50, "short item xy"), (51, "abc"), (52, None), (None, said(rng, 20)), (53, "")]
    rows = [(k, said(rng, rng.choice([5, 50, 400])), None) for k in range(120)]
    for k in range(0, 120, 4):
        item = rng.choice(items[:12])[1]
        part = item[: int(len(item) * rng.choice([0.3, 0.38, 0.45, 0.7, 1.0]))]
        rows.append((200 + k, said(rng, rng.choice([3, 300])) + " " + rng.choice([part, part.upper(), part.replace(" ", "　・")]) + " " + said(rng, 30), None))
    item = items[0][1]
    rows.append((900, item[: len(item) // 4] + said(rng, 40) + item[-len(item) // 3 :], None))
    rows += [(901, said(rng, 20_000) + items[1][1], None), (902, None, None), (903, "", None), (None, items[2][1], None), (904, "SHORT　item xy", None), rows[0]]
    df = docs(spark, rows)
    test = spark.createDataFrame([(i, "s", t) for i, t in items], ITEMS)
    got = {(r.doc_id, r.item_id): r.contained for r in K.leaked_passages(df, "doc_id", "text", test, "item_id", "text").collect()}
    wanted = leaks(rows, items)
    assert set(got) == set(wanted) and all(abs(got[k] - wanted[k]) < 1e-12 for k in got) and len(got) > 15
    # more items than a task takes are joined, with the same result
    joined = {(r.doc_id, r.item_id): r.contained for r in K.leaked_passages(df, "doc_id", "text", test, "item_id", "text", max_items=3).collect()}
    assert joined == got and K.leaked_passages(df, "doc_id", "text", test.where("length(text) < 9"), "item_id", "text", max_items=0).count() == 0
    assert K.leaked_passages(df.where("false"), "doc_id", "text", test, "item_id", "text").count() == 0
    assert K.leaked_passages(df, "doc_id", "text", test.where("false"), "item_id", "text").count() == 0


def test_containment_below_what_the_sketches_are_made_for(spark):
    with pytest.raises(ValueError):
        K.leaked_passages(docs(spark, []), "doc_id", "text", spark.createDataFrame([], ITEMS), "item_id", "text", containment=0.15)


def test_hilbert_neighbours_touch():
    for bits, d in ((3, 2), (2, 3)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * d, indexing="ij"), axis=-1).reshape(-1, d)
        key = C.hilbert_key(cells, bits)
        assert sorted(key) == list(range(side**d))
        steps = np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def test_best_fit():
    placed, rest, following = C.best_fit([6, 5, 4, 0, 3], [(7, 4)], 10, 8)
    assert placed[2] in ((7, 6), (8, 6)) and rest and following == 10
    used = {}
    for size, (b, at) in zip([6, 5, 4, 0, 3], placed, strict=True):
        used[b] = used.get(b, 0) + size
        assert at + size <= 10
    assert C.best_fit([], [], 10, 0) == ([], [], 0)


def test_packing_loses_and_splits_nothing(spark):
    rng = random.Random(2)
    rows = [(k, said(rng, rng.choice([3, 20, 60, 90])), None) for k in range(300)]
    rows += [(400, said(rng, 900), None), (401, None, None), (402, "", None), (None, "x y", None), (403, " ", None), (404, "<|endoftext|>", None), rows[0]]
    capacity = 256
    got = C.pack_documents(docs(spark, rows), "doc_id", "text", capacity=capacity, partitions=3).collect()
    encoder = C.load_tokenizer(C.TOKENIZER)
    size = {k: len(encoder.encode_ordinary(t)) for k, t, _ in rows if t is not None}
    pieces, bins = {}, {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append((r.token_start, r.n_tokens))
        bins.setdefault(r.container_id, []).append((r.offset, r.n_tokens))
    assert set(pieces) == set(size)
    for k, parts in pieces.items():
        whole = sorted(parts)
        if k == 0:
            assert whole == [(0, size[0])] * 2
        elif size[k] <= capacity:
            assert whole == [(0, size[k])]
        else:
            assert [s for s, _ in whole] == list(range(0, size[k], capacity)) and sum(n for _, n in whole) == size[k]
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    total = sum(n for parts in bins.values() for _, n in parts)
    assert total / (len(bins) * capacity) > 0.9
    assert C.pack_documents(docs(spark, []), "doc_id", "text").count() == 0


SENTENCES = {
    "zh": ["炸弹掉落在长廊尽头，他不得不冒险去捡。", "很多人都在问这个地方应该怎么守住。", "我们先看地图，再决定从哪里进攻。"],
    "en": ["The bomb goes down at the crates while the others watch.", "Many people ask how this place should be held.", "We look at the map first and then decide where to attack."],
    "ja": ["爆弾は木箱の裏に設置され、味方が守っている。", "多くの人がこの場所の守り方を聞いています。", "まず地図を見てから攻める場所を決めます。"],
    "ko": ["폭탄은 상자 뒤에 설치되었고 동료가 지키고 있다.", "많은 사람들이 이곳을 어떻게 지켜야 하는지 묻는다.", "먼저 지도를 보고 나서 공격할 곳을 정합니다."],
    "ru": ["Бомба стоит за ящиками, и команда защищает подходы.", "Многие спрашивают, как нужно держать это место.", "Сначала мы смотрим на карту, а потом решаем, где атаковать."],
    "es": ["La bomba está detrás de las cajas y los demás vigilan.", "Mucha gente pregunta cómo hay que defender este lugar.", "Primero miramos el mapa y después decidimos dónde atacar."],
    "pt": ["A bomba está atrás das caixas e os outros vigiam.", "Muita gente pergunta como é que se deve defender este lugar.", "Primeiro olhamos o mapa e depois decidimos onde atacar."],
    "de": ["Die Bombe liegt hinter den Kisten, und die anderen bewachen sie.", "Viele Leute fragen, wie man diese Stelle halten soll.", "Zuerst schauen wir auf die Karte und entscheiden dann, wo wir angreifen."],
    "fr": ["La bombe est posée derrière les caisses et les autres surveillent.", "Beaucoup de gens demandent comment il faut tenir cet endroit.", "Nous regardons d'abord la carte et décidons ensuite où attaquer."],
}


def corpus(rng):
    rows = []
    for k in range(360):
        lang = rng.choice(list(SENTENCES))
        text = " ".join(rng.choice(SENTENCES[lang]) for _ in range(5))
        rows.append((k, text, lang if rng.random() < 0.75 else rng.choice([*SENTENCES, None, "und", ""])))
    return rows


def test_languages_of_whole_and_mixed_documents(spark):
    rng = random.Random(3)
    rows = corpus(rng)
    mixed = [(1000, "".join(SENTENCES["zh"]) + " ".join(SENTENCES["en"]), "zh"), (1001, " ".join(SENTENCES["de"] + SENTENCES["fr"]), None), (1002, "".join(SENTENCES["ko"]) + "".join(SENTENCES["ja"]), "ja")]
    odd = [(2000, None, "zh"), (2001, " 　\n", "en"), (2002, "12345 !!! 678", "en"), (2003, "Bo > Zed\n" + " ".join(SENTENCES["es"]), "es"), (2004, " ".join(SENTENCES["ru"] * 900), "ru"), (None, " ".join(SENTENCES["pt"]), "pt"), rows[0]]
    df = docs(spark, rows + mixed + odd)
    segments = L.language_segments(df, "doc_id", "text", "lang")
    found = {}
    for r in L.document_languages(segments).collect():
        found.setdefault(r.doc_id, set()).add(r.lang)
        assert 0 < r.share <= 1 and 0 < r.confidence <= 1
    truth = {k: {next(lang for lang, s in SENTENCES.items() if any(x in t for x in s))} for k, t, _ in rows}
    right = sum(found[k] == truth[k] for k in truth) / len(truth)
    assert right > 0.98
    assert found[1000] == {"zh", "en"} and found[1001] == {"de", "fr"} and found[1002] == {"ko", "ja"}
    assert found[2003] == {"es"} and found[2004] == {"ru"} and found[None] == {"pt"} and not {2000, 2001} & set(found) and len(found[2002]) == 1
    text = {k: t for k, t, _ in mixed}
    for r in segments.where("doc_id >= 1000 and doc_id < 1003").collect():
        assert text[r.doc_id][r.start : r.stop].strip() and any(x in text[r.doc_id][r.start : r.stop] for x in SENTENCES[r.lang])
    assert L.language_segments(docs(spark, []), "doc_id", "text", "lang").count() == 0


def test_language_sample_is_of_the_whole_table(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(L, "train", lambda texts, labels, make=L.train: seen.extend(labels) or make(texts, labels))
    rows = [(k, " ".join(SENTENCES[lang]), lang) for k, lang in enumerate(x for x in SENTENCES for _ in range(60))]
    assert L.language_segments(docs(spark, rows), "doc_id", "text", "lang", sample_rows=90).count() > 0
    assert len(seen) == 90 and all(seen.count(lang) >= 3 for lang in SENTENCES)


@pytest.mark.parametrize(("label", "lang"), [("zh-CN", "zh"), ("EN_us", "en"), ("ger", "de"), ("und", None), ("", None), (None, None), ("??", None), (" ja ", "ja")])
def test_declared_language(label, lang):
    assert L.declared(label) == lang


LATIN = ("en", "es", "pt", "de", "fr")


def labelled(folder):
    """Texts and labels of the documents table, and the rows of Latin-script languages whose label stopwords confirm."""
    rows = tables(folder).execute("SELECT text, lang FROM documents WHERE trim(coalesce(text, '')) <> '' AND length(text) <= 20000 ORDER BY doc_id").fetchall()
    texts, labels = [t for t, _ in rows], [x for _, x in rows]
    clean = {}
    for k, (t, x) in enumerate(rows):
        votes = language_votes(t).most_common(2)
        if L.declared(x) in LATIN and votes and votes[0][0] == L.declared(x) and (len(votes) == 1 or votes[0][1] > 1.2 * votes[1][1]):
            clean[k] = L.declared(x)
    return texts, labels, clean


def agreement(profiles, texts, clean):
    owner, _, _, lang, _, full = L.segments_of(profiles, [texts[k] for k in clean])
    said = {(k, L.LANGUAGES[x]) for k, x, whole in zip(owner, lang, full, strict=True) if whole}
    spoken = Counter(k for k, _ in said)
    right = [(k, x) in said and spoken[k] <= 2 for k, x in enumerate(clean.values())]
    return {x: np.mean([r for r, y in zip(right, clean.values(), strict=True) if y == x]) for x in sorted(set(clean.values()))}


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_languages_agree_with_clean_labels_at_every_size(data, scale):
    folder = os.path.join(os.path.dirname(data.rstrip("/")), scale)
    if not os.path.isdir(folder):
        pytest.skip("the table of this size is not here")
    texts, labels, clean = labelled(folder)
    texts, labels, clean = texts[:2000], labels[:2000], {k: x for k, x in clean.items() if k < 2000}
    assert "en" in clean.values()
    for withheld in (None, "fr") if scale == "sf0.1" else (None, *LATIN, "all"):
        given = [None if withheld in ("all", L.declared(x)) else x for x in labels]
        found = agreement(L.train(texts, given), texts, clean)
        assert min(found.values()) >= 0.9, (withheld, found)


@pytest.mark.parametrize("lang", sorted(SENTENCES))
def test_seeds_alone_tell_languages(lang):
    _, _, _, found, _, _ = L.segments_of(L.train([], []), [" ".join(SENTENCES[lang])])
    assert [L.LANGUAGES[k] for k in found] == [lang]


def test_a_short_full_sentence_between_others():
    text = "".join(SENTENCES["zh"]) + "Он ждёт." + "".join(SENTENCES["zh"])
    profiles = L.train(["".join(SENTENCES["zh"]), " ".join(SENTENCES["ru"])], [None, None])
    _, start, stop, lang, _, full = L.segments_of(profiles, [text])
    assert [L.LANGUAGES[k] for k in lang] == ["zh", "ru", "zh"] and full.all() and text[start[1] : stop[1]] == "Он ждёт."


def test_cosines_are_those_of_the_bundles(monkeypatch):
    profiles = L.train([], [])
    grams = L.Grams([" ".join(x) for x in SENTENCES.values()] + ["Xqzw vjkx qqqq qqqq qqqq. 犇犇犇犇犇犇"])
    cos = profiles.cosines(grams)
    for k in range(grams.count):
        bundle = L.vectors(grams.codes[grams.code_of == k]).astype(np.float64).sum(axis=0)
        length = np.linalg.norm(bundle)
        assert abs(np.sqrt(grams.squares()[k] * L.DIMENSIONS) / length - 1) < 0.06
        assert np.abs(bundle @ profiles.prototypes.T / length - cos[k]).max() < 0.02
    monkeypatch.setattr(L, "CACHE_BITS", 4)  # a cache of hardly any n-gram changes nothing
    assert np.allclose(L.Profiles(profiles.prototypes).cosines(grams), cos, atol=1e-5)


def test_letter_vectors_are_fixed_and_nearly_orthogonal():
    a = L.letter_vectors(np.array([97, 98, 0x4E2D]))
    assert (a == L.letter_vectors(np.array([97, 98, 0x4E2D]))).all()
    products = a.astype(int) @ a.T.astype(int) / L.DIMENSIONS
    assert np.allclose(np.diag(products), 1) and np.abs(products - np.eye(3)).max() < 0.1


def test_sentences_end_at_text_ends_and_marks():
    grams = L.Grams(["Go left. Now\nthen", "", "One line.", "中。文"])
    assert grams.owner.tolist() == [0, 0, 0, 2, 3, 3] and grams.marked.tolist() == [True, False, False, True, True, False]
    assert grams.letters.tolist() == [6, 3, 4, 7, 1, 1]
