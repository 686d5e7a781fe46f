"""Languages of documents and of their mixed segments, by hyperdimensional n-gram profiles.

Every letter has a fixed random vector of +-1; a trigram is the product of its letters' vectors permuted by
position, a single letter its own vector; texts and languages are bundles (sums) of their n-grams, compared
by cosine. As the inner product is linear, a text's product with a prototype is the sum of its n-grams'
products, each made from the n-gram's vector, whether training saw it or not. The prototypes start from a few
plain sentences per language, which tell the languages apart on their own; a bounded sample of the documents
then refines them in a few rounds, its labels being no more than a weak hint.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliplake.llm.chars import code_points, mix, text_slices

LANGUAGES = ("zh", "en", "ja", "ko", "ru", "es", "pt", "de", "fr")
DIMENSIONS = 4096
#: Bounds of the training sample.
SAMPLE_ROWS = 2_000
SAMPLE_CHARS = 10_000  # longer documents are not picked for the sample
#: Slots of a worker's cache of n-gram products; what is not in it is made anew, so its size changes no result.
CACHE_BITS = 20
SMOOTHING = 0.25  # pseudo-use of each n-gram, as a share of the mean use of a language's n-grams
LABEL_HINT = 0.1  # what a document's label adds to its language's mean cosine in training
RELABEL = 0.15  # margin beyond which a training sentence has a language of its own
FIRST_ALONE = 0x370  # letters from here on also count alone; Latin ones are shared by too many languages
LEAST_LETTERS = 12
LEAST_WIDE = 5
MARGIN = 0.04
# a marked sentence below those sizes is sure only by a wider margin
SHORT_LETTERS, SHORT_WIDE, SHORT_MARGIN = 5, 3, 0.1

#: Language names beside the two-letter codes, fixed values of the ISO 639 code lists.
CODES = {
    "zho": "zh", "chi": "zh", "cmn": "zh", "eng": "en", "jpn": "ja", "kor": "ko", "rus": "ru", "spa": "es", "por": "pt", "deu": "de", "ger": "de", "fra": "fr", "fre": "fr",
}

# Plain sentences per language from which the prototypes start. The five Latin-script languages need some
# hundred words each to be told apart by them alone; the others are known by their letters.
SEEDS = {
    "zh": "我们今天要讨论这个问题，因为很多人都在问应该怎么做。他们已经到了那里，但是没有看到任何人。如果你有时间，请先看看这个地图，然后再选择位置。",
    "en": "We want to talk about this question today because many people have asked what they should do. They went there but did not see anyone. If you have time, look at the map first and then choose the position."
    " This is not the first time that it has happened, and it will not be the last. Both of them were there before, but now they are on the other side. You can see that the door was left open while someone was waiting behind it. Which of these would be better for the rest of the team? When the others come back, we should tell them what we know about it. She does not think so, because there is nothing more to say. If he had known this earlier, he would have stayed with his friends and tried again from another way. After that, each player takes only one thing and keeps it until the end of the game.",
    "ja": "今日はこの問題について話したいと思います。多くの人がどうすればいいかを聞いているからです。彼らはそこに行きましたが、誰も見ませんでした。時間があれば、まず地図を見てから場所を選んでください。",
    "ko": "오늘은 이 문제에 대해 이야기하려고 합니다. 많은 사람들이 어떻게 해야 하는지 물었기 때문입니다. 그들은 그곳에 갔지만 아무도 보지 못했다. 시간이 있으면 먼저 지도를 보고 위치를 고르세요.",
    "ru": "Сегодня мы хотим поговорить об этом вопросе, потому что многие люди спрашивали, что им делать. Они пришли туда, но никого не увидели. Если у вас есть время, сначала посмотрите на карту, а потом выберите место.",
    "es": "Hoy queremos hablar de esta cuestión porque muchas personas han preguntado qué deberían hacer. Fueron allí pero no vieron a nadie. Si tienes tiempo, mira primero el mapa y después elige la posición. Los jugadores no saben cuándo llega el enemigo."
    " Esta no es la primera vez que pasa, y tampoco será la última. Los dos estaban allí antes, pero ahora están al otro lado. Se puede ver que la puerta quedó abierta mientras alguien esperaba detrás de ella. ¿Cuál de estas sería mejor para el resto del equipo? Cuando vuelvan los otros, tenemos que decirles lo que sabemos de esto. Ella no lo cree así, porque ya no hay nada más que decir. Si él lo hubiera sabido antes, se habría quedado con sus amigos y lo habría intentado otra vez por otro camino. Después de eso, cada jugador toma solo una cosa y la guarda hasta el final del juego.",
    "pt": "Hoje queremos falar sobre esta questão porque muitas pessoas perguntaram o que deveriam fazer. Eles foram até lá mas não viram ninguém. Se você tiver tempo, olhe primeiro o mapa e depois escolha a posição. Os jogadores não sabem quando chega o inimigo."
    " Esta não é a primeira vez que isso acontece, e também não será a última. Os dois estavam lá antes, mas agora estão do outro lado. Dá para ver que a porta ficou aberta enquanto alguém esperava atrás dela. Qual destas seria melhor para o resto da equipe? Quando os outros voltarem, temos de lhes dizer o que sabemos sobre isso. Ela não pensa assim, porque já não há mais nada a dizer. Se ele tivesse sabido disso antes, teria ficado com os seus amigos e tentado outra vez por outro caminho. Depois disso, cada jogador pega apenas uma coisa e guarda-a até ao fim do jogo.",
    "de": "Heute wollen wir über diese Frage sprechen, weil viele Leute gefragt haben, was sie tun sollen. Sie gingen dorthin, aber sie sahen niemanden. Wenn du Zeit hast, schau dir zuerst die Karte an und wähle dann die Stellung. Die Spieler wissen nicht, wann der Gegner kommt."
    " Das ist nicht das erste Mal, dass es passiert, und es wird auch nicht das letzte Mal sein. Die beiden waren schon vorher da, aber jetzt sind sie auf der anderen Seite. Man kann sehen, dass die Tür offen blieb, während jemand hinter ihr wartete. Welche davon wäre besser für den Rest der Mannschaft? Wenn die anderen zurückkommen, müssen wir ihnen sagen, was wir darüber wissen. Sie glaubt das nicht, weil es nichts mehr zu sagen gibt. Hätte er das früher gewusst, wäre er bei seinen Freunden geblieben und hätte es noch einmal auf einem anderen Weg versucht. Danach nimmt jeder Spieler nur eine Sache und behält sie bis zum Ende des Spiels.",
    "fr": "Aujourd'hui nous voulons parler de cette question parce que beaucoup de gens ont demandé ce qu'ils devraient faire. Ils y sont allés mais ils n'ont vu personne. Si tu as le temps, regarde d'abord la carte et choisis ensuite la position. Les joueurs ne savent pas quand l'ennemi arrive."
    " Ce n'est pas la première fois que cela arrive, et ce ne sera pas non plus la dernière. Les deux étaient déjà là avant, mais maintenant ils sont de l'autre côté. On peut voir que la porte est restée ouverte pendant que quelqu'un attendait derrière elle. Laquelle de celles-ci serait la meilleure pour le reste de l'équipe ? Quand les autres reviendront, nous devrons leur dire ce que nous en savons. Elle ne le croit pas, parce qu'il n'y a plus rien à dire. S'il l'avait su plus tôt, il serait resté avec ses amis et aurait essayé encore une fois par un autre chemin. Après cela, chaque joueur ne prend qu'une seule chose et la garde jusqu'à la fin du jeu.",
}

EMPTY = np.uint64((1 << 64) - 1)
_FOLD: np.ndarray | None = None
_MARKS = np.array([ord(c) for c in "。！？!?…；．"], np.uint32)


def _fold() -> np.ndarray:
    """Code point to its lower-case letter, 0 for what is no letter."""
    global _FOLD
    if _FOLD is None:
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = (unicodedata.normalize("NFKC", ch) if 0xFF00 <= c <= 0xFFEF else ch).lower()
                table[c] = ord(low) if len(low) == 1 else c
        _FOLD = table
    return _FOLD


def letter_vectors(letters: np.ndarray) -> np.ndarray:
    """The fixed random +-1 vectors of code points (n x DIMENSIONS, int8)."""
    words = mix(letters.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + mix(np.arange(1, DIMENSIONS // 64 + 1, dtype=np.uint64))[None, :])
    bits = np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=1)
    return bits.astype(np.int8) * 2 - 1


def trigram_vectors(codes: np.ndarray) -> np.ndarray:
    """Bound vectors of packed trigrams: letters permuted by position, multiplied."""
    low = np.uint64((1 << 21) - 1)
    a, b, c = codes >> np.uint64(42), (codes >> np.uint64(21)) & low, codes & low
    return np.roll(letter_vectors(a), 2, axis=1) * np.roll(letter_vectors(b), 1, axis=1) * letter_vectors(c)


class Grams:
    """The n-grams of a batch of texts, by sentence: trigrams, and letters that tell a script."""

    def __init__(self, texts: list[str]):
        flat, offsets = code_points(texts)
        n = len(flat)
        self.offsets = offsets
        newline = (flat == 10) | (flat == 13)
        follows_space = np.ones(n, bool)
        follows_space[:-1] = np.isin(flat[1:], np.array([32, 10, 13, 9, 34, 39, 41], np.uint32)) | (flat[1:] >= 0x2E80)
        last = offsets[1:][np.diff(offsets) > 0] - 1
        follows_space[last] = True  # what follows there is another text
        mark = np.isin(flat, _MARKS) | ((flat == 46) & follows_space)
        ends = mark | newline
        ends[last] = True
        self.sentence = np.concatenate([[0], np.cumsum(ends)[:-1]]) if n else np.empty(0, np.int64)
        self.count = int(ends.sum())
        stop = np.flatnonzero(ends)
        self.start = np.concatenate([[0], stop[:-1] + 1]) if n else np.empty(0, np.int64)
        self.stop = stop + 1
        self.marked = mark[stop]
        self.owner = np.searchsorted(offsets, self.start, "right") - 1
        letters = _fold()[flat]
        keep = np.ones(n, bool)
        keep[1:] = (letters[1:] != 0) | (letters[:-1] != 0)
        self.letter, self.of = letters[keep].astype(np.uint64), self.sentence[keep]
        inside = self.letter != 0
        self.letters = np.bincount(self.of[inside], minlength=self.count)
        wide = inside & (self.letter >= 0x2E80)
        self.wide = np.bincount(self.of[wide], minlength=self.count)
        if len(self.letter) > 2:
            codes = (self.letter[:-2] << np.uint64(42)) | (self.letter[1:-1] << np.uint64(21)) | self.letter[2:]
            whole = (self.of[:-2] == self.of[2:]) & (self.letter[1:-1] != 0)
            # Latin names inside a sentence of wide letters say nothing of its language
            named = (self.wide * 3 > self.letters - self.wide)[self.of[:-2]] & (self.letter[1:-1] < FIRST_ALONE)
            whole &= ~named
            codes, code_of = codes[whole], self.of[:-2][whole]
        else:
            codes, code_of = np.empty(0, np.uint64), np.empty(0, np.int64)
        single = self.letter >= FIRST_ALONE
        self.codes = np.concatenate([codes, self.letter[single]])
        self.code_of = np.concatenate([code_of, self.of[single]])

    def squares(self) -> np.ndarray:
        """The squared length of each sentence's bundle over DIMENSIONS: an n-gram that occurs k times counts k * k.

        Different n-grams' vectors are orthogonal up to 1 / sqrt(DIMENSIONS), which leaves a length right to about 2 %.
        """
        if not len(self.codes):
            return np.zeros(self.count)
        bits = np.uint64(max(1, int(self.count - 1).bit_length()))
        key = np.sort((self.code_of.astype(np.uint64) << (np.uint64(64) - bits)) | (mix(self.codes) >> bits))
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        times = np.diff(np.append(start, len(key)))
        return np.bincount((key[start] >> (np.uint64(64) - bits)).astype(np.int64), times.astype(float) ** 2, self.count)


class Profiles:
    """Language prototypes, with which any n-gram is compared; see the module's description."""

    def __init__(self, prototypes: np.ndarray):
        self.prototypes = prototypes.astype(np.float32)  # languages x DIMENSIONS, unit vectors
        self._cache: tuple[np.ndarray, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return {"prototypes": self.prototypes, "_cache": None}

    def products(self, codes: np.ndarray) -> np.ndarray:
        """Inner products of n-grams' vectors (packed trigrams, or letters alone) with the prototypes."""
        if self._cache is None:
            self._cache = np.full(1 << CACHE_BITS, EMPTY), np.zeros((1 << CACHE_BITS, len(LANGUAGES)), np.float32)
        keys, held = self._cache
        slot = (mix(codes) >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        out = held[slot]
        missed = np.flatnonzero(keys[slot] != codes)
        if len(missed):
            fresh, at = np.unique(codes[missed], return_inverse=True)
            made = multiply(fresh, self.prototypes)
            out[missed] = made[at]
            slot = (mix(fresh) >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
            keys[slot], held[slot] = fresh, made
            twice = keys[slot] != fresh  # of two n-grams in one slot the last stays
            held[slot[~twice]] = made[~twice]
        return out

    def cosines(self, grams: Grams) -> np.ndarray:
        """Cosine of each sentence's bundle with each prototype (sentences x languages)."""
        scores = self.products(grams.codes)
        out = np.stack([np.bincount(grams.code_of, scores[:, k], grams.count) for k in range(len(LANGUAGES))], axis=1)
        return out / np.sqrt(np.maximum(grams.squares(), 1) * DIMENSIONS)[:, None]


def vectors(codes: np.ndarray) -> np.ndarray:
    """The vectors of n-grams: bound trigrams where three letters are packed, else the letter's own."""
    out = np.empty((len(codes), DIMENSIONS), np.int8)
    single = codes < np.uint64(1 << 21)
    out[single] = letter_vectors(codes[single])
    out[~single] = trigram_vectors(codes[~single])
    return out


def multiply(codes: np.ndarray, prototypes: np.ndarray, step: int = 2_048) -> np.ndarray:
    made = [np.empty((0, len(LANGUAGES)), np.float32)]
    made += [vectors(codes[at : at + step]).astype(np.float32) @ prototypes.T for at in range(0, len(codes), step)]
    return np.concatenate(made)


def bundle(codes: np.ndarray, weights: np.ndarray, step: int = 2_048) -> np.ndarray:
    """The languages' prototypes: unit bundles of the n-grams' vectors with the given weights by language."""
    out = np.zeros((len(LANGUAGES), DIMENSIONS), np.float32)
    used = weights.any(axis=1)
    codes, weights = codes[used], weights[used].astype(np.float32)
    for at in range(0, len(codes), step):
        out += weights[at : at + step].T @ vectors(codes[at : at + step]).astype(np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _weights(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """How strongly each n-gram enters each language's bundle: by its use among ``total`` (by language), as far
    as the language has more than twice its even share of it. Only proportions count, so any size behaves alike."""
    pseudo = SMOOTHING * total.mean()
    use = (counts + pseudo * counts.sum(axis=1, keepdims=True) / max(total.sum(), 1)) / np.maximum(total + pseudo, 1e-12)
    share = use / np.maximum(use.sum(axis=1, keepdims=True), 1e-12)
    return np.maximum(share - 2 / len(LANGUAGES), 0) * use


def declared(label: str | None) -> str | None:
    """The language that a label names, by its primary subtag; None if it names none."""
    tag = re.split(r"[-_]", (label or "").strip().lower())[0]
    tag = CODES.get(tag, tag)
    return tag if re.fullmatch(r"[a-z]{2}", tag) else None


def train(texts: list[str], labels: list[str | None], rounds: int = 4) -> Profiles:
    """Prototypes from texts whose labels are partly wrong or missing; with no text, those of the seeds.

    Each round compares the sentences with the prototypes so far. A sentence that is surely in one language
    gets it; any other gets that of its text, the language with the highest mean cosine, the label's own
    raised by LABEL_HINT.
    """
    known = {lang: k for k, lang in enumerate(LANGUAGES)}
    size, every = len(LANGUAGES), [*texts, *SEEDS.values()]
    # a slice of the texts at a time, of which small numbers stay: the n-gram of each place, and its sentence
    parts, places, sentences = [], [], 0
    for at, stop in text_slices(every, 500):
        grams = Grams(every[at:stop])
        own, where = np.unique(grams.codes, return_inverse=True)
        parts.append((own, grams.letters, grams.owner + at, grams.squares()))
        places.append((where.astype(np.int32), (grams.code_of + sentences).astype(np.int32)))
        sentences += grams.count
    codes = np.unique(np.concatenate([own for own, *_ in parts]))
    code_at = np.concatenate([np.searchsorted(codes, own).astype(np.int32)[where] for (own, *_), (where, _) in zip(parts, places, strict=True)])
    code_of = np.concatenate([of for _, of in places])
    letters, owner, squares = (np.concatenate([part[k] for part in parts]) for k in (1, 2, 3))
    del parts, places
    seed = np.array([known[x] for x in SEEDS])
    real = owner < len(texts)
    fixed = np.where(real, -1, seed[np.maximum(owner - len(texts), 0)])
    hint = np.zeros((len(every), size))
    for k, label in enumerate(labels):
        if (lang := known.get(declared(label))) is not None:
            hint[k, lang] = LABEL_HINT
    alone = codes < np.uint64(1 << 21)
    weight = np.sqrt(letters)
    mass = np.maximum(np.bincount(owner, weight, len(every)), 1)[:, None]
    length = np.sqrt(np.maximum(squares, 1) * DIMENSIONS)[:, None]
    assigned, emphasis = fixed, np.ones(sentences)
    for turn in range(rounds):
        counts = np.zeros((len(codes), size))
        total = np.zeros(size)
        for k in range(size):
            used = emphasis * (assigned == k)
            counts[:, k] = np.bincount(code_at, used[code_of], len(codes))
            total[k] = (used * letters).sum()
        weights = np.zeros(counts.shape)
        weights[alone], weights[~alone] = _weights(counts[alone], total), _weights(counts[~alone], counts[~alone].sum(axis=0))
        profiles = Profiles(bundle(codes, weights))
        if turn < rounds - 1:
            scores = multiply(codes, profiles.prototypes)
            cos = np.stack([np.bincount(code_of, scores[code_at, k], sentences) for k in range(size)], axis=1) / length
            best = cos.argmax(axis=1)
            top = np.sort(cos, axis=1)
            surely = (letters >= 20) & (top[:, -1] - top[:, -2] > RELABEL)
            mean = np.stack([np.bincount(owner, cos[:, k] * weight, len(every)) for k in range(size)], axis=1) / mass
            voted = (mean + hint).argmax(axis=1)[owner]
            assigned = np.where(real, np.where(surely, best, voted), fixed)
            # sentences near a wrong prototype weigh more in the next round
            emphasis = np.where((best != assigned) & (letters >= 8), emphasis * 2, emphasis)
    return profiles


_SEGMENTS = pa.schema(
    [("doc_id", pa.int64()), ("label", pa.string()), ("segment", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("lang", pa.string()), ("confidence", pa.float64()), ("full", pa.bool_())]
)
_SEGMENTS_DDL = "doc_id long, label string, segment int, start long, stop long, lang string, confidence double, full boolean"


def _smooth(cos: np.ndarray, best: np.ndarray, sure: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Unsure sentences take the nearer of the languages of their text's last and next sure ones, else their own."""
    n = len(best)
    at = np.arange(n)
    back = np.maximum.accumulate(np.where(sure, at, -1))
    ahead = np.minimum.accumulate(np.where(sure, at, n)[::-1])[::-1]
    before = (back >= 0) & (owner[np.maximum(back, 0)] == owner)
    behind = (ahead < n) & (owner[np.minimum(ahead, n - 1)] == owner)
    last, following = best[np.maximum(back, 0)], best[np.minimum(ahead, n - 1)]
    nearer = np.where(cos[at, last] >= cos[at, following], last, following)
    return np.where(sure, best, np.where(before & behind, nearer, np.where(before, last, np.where(behind, following, best))))


def segments_of(profiles: Profiles, texts: list[str]) -> tuple[np.ndarray, ...]:
    """(text index, start, stop, language index, confidence, full) of the one-language segments of texts.

    Confidence is the share of the language among the segment's evidence, a softmax of the cosines. Full says
    that the segment has a whole sentence that is surely in the language; a sentence that is not sure goes with
    its neighbours.
    """
    grams = Grams(texts)
    if not grams.count:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64, float, bool))
    cos = profiles.cosines(grams)
    best = cos.argmax(axis=1)
    top = np.partition(cos, -2, axis=1)[:, -2:]
    margin = np.abs(top[:, 1] - top[:, 0])
    short = grams.marked & ((grams.letters >= SHORT_LETTERS) | (grams.wide >= SHORT_WIDE))
    sure = ((grams.letters >= LEAST_LETTERS) | (grams.wide >= LEAST_WIDE)) & (margin > MARGIN) | short & (margin > SHORT_MARGIN)
    lang = _smooth(cos, best, sure, grams.owner)
    fresh = np.ones(len(lang), bool)
    fresh[1:] = (lang[1:] != lang[:-1]) | (grams.owner[1:] != grams.owner[:-1])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(lang)) - 1
    group = np.cumsum(fresh) - 1
    weight = grams.letters + 1
    soft = np.exp(12 * (cos - cos.max(axis=1, keepdims=True)))
    soft /= soft.sum(axis=1, keepdims=True)
    own = soft[np.arange(len(lang)), lang] * weight
    confidence = np.bincount(group, own) / np.bincount(group, weight)
    whole = np.bincount(group, sure & (best == lang) & grams.marked) > 0
    return grams.owner[first], grams.start[first], grams.stop[last], lang[first], confidence, whole


def language_segments(documents: DataFrame, doc: str, text: str, label: str, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, label, segment, start, stop, lang, confidence, full) of every document's segments.

    A segment is a longest run of sentences of one language; start and stop are code-point positions. Null
    and blank texts have no segment; a text without letters is one segment of the nearest prototype. Ids and
    rows are kept as they come, repeated rows too. An empty table gives no rows; other columns are not read.
    """
    rows = documents.select(
        F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(label).cast("string").alias("label")
    ).where(F.col("text").rlike(r"(?U)[^\s\x1c-\x1f]"))
    total = rows.count()
    share = min(1.0, 2 * sample_rows / max(total, 1))
    placed = rows.select("doc_id", "text", "label", F.xxhash64("doc_id").alias("place"))
    picked = placed.where(F.pmod("place", F.lit(1_000_000)) < int(share * 1_000_000) + 1).where(F.length("text") <= SAMPLE_CHARS)
    picked = picked.orderBy("place", "doc_id", "text", "label").limit(sample_rows)  # in hash order: from the whole table
    sample = sorted((r.doc_id if r.doc_id is not None else -1, r.text, r.label or "") for r in picked.collect())
    shared = documents.sparkSession.sparkContext.broadcast(train([t for _, t, _ in sample], [x for *_, x in sample]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = shared.value
        names = np.array(LANGUAGES, dtype=object)
        for whole in batches:
            texts = whole.column("text").to_pylist()
            for at, end in text_slices(texts, 1_000):
                batch = whole.slice(at, end - at)
                owner, start, stop, lang, confidence, full = segments_of(profiles, texts[at:end])
                base = np.concatenate([[0], np.cumsum([len(t) for t in texts[at:end]])])[owner]
                fresh = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.empty(0, bool)
                number = np.arange(len(owner)) - np.maximum.accumulate(np.where(fresh, np.arange(len(owner)), 0)) if len(owner) else owner
                take = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(take), batch.column("label").take(take), pa.array(number.astype(np.int32)),
                        pa.array(start - base), pa.array(stop - base), pa.array(names[lang], pa.string()), pa.array(confidence), pa.array(full),
                    ],
                    schema=_SEGMENTS,
                )

    return rows.select("doc_id", "label", "text").mapInArrow(run, _SEGMENTS_DDL)


def document_languages(segments: DataFrame) -> DataFrame:
    """(doc_id, label, lang, share, confidence, n_languages): the languages of each document of ``segments``.

    A language counts if one of its segments has a full sentence; a document without any full sentence has
    the language of most of its characters.
    """
    size = F.col("stop") - F.col("start")
    by = segments.groupBy("doc_id", "label", "lang").agg(
        F.sum(size).alias("chars"), F.max("full").alias("full"), (F.sum(F.col("confidence") * size) / F.sum(size)).alias("confidence")
    )
    doc = F.struct("chars", "full", "lang", "confidence")
    all_langs = by.groupBy("doc_id", "label").agg(F.collect_list(doc).alias("langs"))  # at most one entry per language
    full = F.filter("langs", lambda x: x["full"])
    kept = F.when(F.size(full) > 0, full).otherwise(F.slice(F.sort_array("langs", asc=False), 1, 1))
    total = F.aggregate("langs", F.lit(0).cast("long"), lambda acc, x: acc + x["chars"])
    wide = all_langs.select("doc_id", "label", total.alias("total"), kept.alias("kept"))
    flat = wide.select("doc_id", "label", "total", F.size("kept").alias("n_languages"), F.explode("kept").alias("x"))
    return flat.select("doc_id", "label", F.col("x.lang").alias("lang"), (F.col("x.chars") / F.col("total")).alias("share"), F.col("x.confidence").alias("confidence"), "n_languages")
