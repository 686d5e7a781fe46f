"""Prompt and response pairs that cannot be used, each with its defect.

A suffix automaton of the prompt is traversed with the response to measure how much of it is copied; an
automaton of cues finds refusals, by their subject, act and place; a delimiter stack and the regression of :mod:`truncation`, trained on cuts of
every intact response, find broken ends, and short phrases are looked up among all of them; script counts and
stopword votes find the wrong language.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliplake.llm.truncation import BITS, MARKS, features, fit_slots, make_examples, probability, strip_wrapping
from cliplake.session import table_partitions, write_out

#: Distinct answers that a task trains on at once; each of the table is in one of the shards.
SHARD_ROWS = 2_000
#: Parts of a weight in which the models of the shards are summed: whole numbers add up the same in any order.
UNIT = 1 << 20
#: Feature numbers whose sums go in one row.
BLOCK = 256
#: Characters of a short phrase that are looked up among the beginnings of the intact answers.
HEAD = 13
#: Characters and words of the longest name that is looked up word by word.
NAME, NAME_WORDS = 24, 3
#: Keys that a task counts before it hands them on.
HELD_KEYS = 200_000

NOTHING = frozenset(
    "无 没有 暂无 空 略 未知 不详 null none nil na nan n/a nothing empty blank tbd todo unknown 无答案 暂无答案 noanswer undefined 没有答案 なし 없음 нет nada nichts rien".split()
)
_LABEL = re.compile(
    r"^(?:(?:答案?|回答|回复|answers?|a|response|reply|output|assistant|答え|回答例|respuesta|resposta|antwort|réponse|ответ|답변?)\s*\d*\s*[:：]\s*)+", re.I
)
_ASKED = re.compile(
    r"^(?:关于您的提问|您问的是|你问的是|您的问题是|你的问题是|题目是?|问题\s*\d*|问|提问|question\s*\d*|q\s*\d*|you asked|you ask|your question(?: is| was)?|about your question|the question(?: is| was)?|prompt)\s*[:：,，\-—]?\s*",
    re.I,
)
_NOTE = re.compile(r"\s*[（(](?:术语|callout|注|note|备注|term|terms)\s*[:：][^()（）]*[)）]\s*$", re.I)

# How an assistant declines: a cue, found by an automaton, whose subject is the assistant (or nobody) and which is
# followed by an act of answering. Kinds of cues: "neg" needs both, "own" the subject only, "scope" is whole in
# itself, "rule" needs the request as its subject or nobody.
CUES = {
    "neg": (
        "无法 不能 不便 没法 没有办法 没办法 难以 不予 不方便 拒绝 选择不 恕不 无从 不可以 不被允许 没有权限 无权".split(),
        [
            "cannot", "can not", "can't", "cant", "could not", "couldn't", "won't", "will not", "unable to", "not able to", "not allowed to", "not permitted to", "not in a position to",
            "rather not", "prefer not to", "not feel able to", "don't feel able to", "decline to", "declines to", "refuse to", "do not", "don't", "not comfortable", "no answer can",
        ],
    ),
    "own": (
        "答不上来 回答不了 回答不上 帮不了 帮不上 无可奉告 爱莫能助 恕难从命 看不到画面 看不到视频 看不到图像 看不到片段 看不到这".split(),
        ["must decline", "have to decline", "have no access to", "do not have access to", "don't have access to", "no access to", "have to pass on", "must refuse"],
    ),
    "scope": (
        "超出了我的 超出我的 超过了我的 不在我的能力 不属于我的能力".split(),
        [
            "outside of what i can", "outside what i can", "beyond what i can", "not within what i can", "not something i can", "beyond my abilities", "beyond my capabilities", "outside my abilities",
            "outside my capabilities", "outside my scope", "beyond my scope", "my guidelines keep me from", "my guidelines do not allow", "my guidelines don't allow", "my guidelines prevent", "my rules do not allow",
            "my rules keep me from", "my instructions do not allow",
        ],
    ),
    "rule": (
        "不符合使用规范 违反使用规范 违反了使用规范 不符合规定 违反规定 违反了规定 不符合使用政策 违反使用政策 违反了使用政策 涉及敏感".split(),
        ["violates the usage", "violate the usage", "violates my", "violates the content policy", "violates usage", "violates our", "against my guidelines", "against the usage", "against my rules", "against the rules for", "against our"],
    ),
}
# The same in seven other languages, each phrase whole in itself.
ELSEWHERE = ("回答できません", "お答えできません", "no puedo responder", "não posso responder", "kann ich nicht beantworten", "je ne peux pas répondre", "не могу ответить", "답변할 수 없")
_ACT_ZH = re.compile(
    r"(?:对此|就此|为您|给您|向您|继续|直接|再|对这个问题|就这个问题)?(?:(?:作出|做出|给出|提供|进行)(?:任何|相关|明确|更多|该|此|这些|这类|的)*(?:回答|解答|答案|答复|帮助|信息|回应|评论|说明|协助)"
    r"|(?:协助|帮助)?(?:处理|满足|完成|执行)?(?:这一?|此|该|您的|你的)?(?:个|类|项)?(?:请求|要求|提问)|回答|作答|解答|答复|回应|讨论|评论|透露|协助(?:您|你|处理|这)|帮助?(?:您|你|到您|到你)"
    r"|(?:观看|访问|查看|看到|打开|读取|获取|接触到?)(?:到)?(?:该|这|此|您的|你的|相关|任何)?(?:个|段|一)?(?:视频|画面|片段|图像|内容|文件|链接|录像|资料|信息))"
)
_ACT_EN = re.compile(
    r"\s*(?:to\s+)?(?:really\s+|directly\s+|properly\s+|currently\s+)?(?:(?:answer|answering|respond|reply|comply|discuss|discussing|comment)\b|assist\b|help(?:\s+(?:with|you)\b|\s*(?:[.,!;:]|$|here))"
    r"|(?:provide|give|offer|share)\s+(?:\w+\s+){0,3}?(?:answers?|information|help|assistance|details|advice|responses?|opinions?|that|this|it|more)\b|do\s+(?:that|this|so)\b|feel able to (?:answer|respond)"
    r"|(?:watch|view|see|access|open|play)\s+(?:\w+\s+){0,2}?(?:videos?|clips?|footage|images?|pictures?|screen|content|recordings?|files?|links?)\b|be\s+(?:answered|given|discussed|provided)\b)"
)
_SELF_ZH = re.compile(r"(?<![敌自])(?:我们?|本助手|本模型|本人|恕)(?:实在|暂时|目前|现在|也|还|确实|恐怕|只能|都|并)*$")
_SELF_EN = re.compile(r"(?:^|[^\w])(?:i|i'm|i am|i'd|i would|i do|i have|we|we are|we're|me)(?:\s+(?:am|are|also|really|simply|currently|unfortunately|still|would|just|must|have to|therefore))*\s*$")
_NOBODY = re.compile(
    r"(?:\s|所以|因此|因而|但是?|不过|抱歉|对不起|很遗憾|遗憾的是|不好意思|请谅解|可惜|目前|暂时|现在|恐怕|很|也|恕我?"
    r"|so|but|and|therefore|sorry|unfortunately|however|regrettably|please note that|apologies|thus|hence|also)*$"
)
_REQUEST = re.compile(r"问题|请求|提问|内容|要求|话题|request|question|topic|content|this|that|it\b|asking|answer")
IMPERATIVE = ("do not", "don't")  # without a subject these tell the reader what not to do
#: Sentences of an answer in which it can decline; a later one speaks of something else.
DECLINE_WITHIN = 2

# Frequent function words of five languages.
STOPWORDS = {
    "en": "the a an and or of to in on at is are was were be it this that with for from by as so not but his her its they them then before after while which who what when where how into because has have had do does did can will would there their also up out one two",
    "es": "el la los las un una unos unas y o de del que en es son fue ser con por para como no pero su sus se lo al más si ya muy este esta esto cuando donde hay tiene han desde hasta sin sobre también entre todos nos le les antes",
    "pt": "o a os as um uma uns umas e ou de do da dos das que em no na nos nas é são foi ser com por para como não mas seu sua seus suas se ao à mais já muito este esta isto quando onde há tem desde até sem sobre também entre todos lhe pelo pela antes",
    "de": "der die das ein eine einen einem einer und oder von zu im in ist sind war sein mit für auf als so nicht aber sich es er sie wir ihr dem den des auch wenn wie wo hat haben wird werden nach vor bei aus noch nur mehr man zum zur deshalb dann weil wurde wurden damit über um unter gegen durch ohne immer schon zuerst sehr",
    "fr": "le la les un une des et ou de du que qui en est sont était être avec par pour comme ne pas mais son sa ses se ce cette au aux plus si déjà très quand où il elle ils on nous vous dans sur aussi entre sans depuis tout leur avant puis",
}
_VOTES: dict[str, list[str]] = {}
for _lang, _words in STOPWORDS.items():
    for _w in _words.split():
        _VOTES.setdefault(_w, []).append(_lang)
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_NOT_ALNUM = re.compile(r"[\W_]+")
_SENTENCE = re.compile(r"[。！？!?\n]|\.(?=\s|$)")
_CLAUSE = re.compile(r"[，。！？；：、,.!?;:\n]")
_WIDE = re.compile("[\u0400-\u052f\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7af]")
_HAN, _KANA, _HANGUL, _CYRILLIC = (re.compile(f"[{x}]") for x in ("\u4e00-\u9fff\u3400-\u4dbf", "\u3040-\u30ff", "\uac00-\ud7af", "\u0400-\u052f"))
_TOKEN = re.compile(r"[A-Za-z0-9][A-Za-z0-9_-]*")
_RUN = re.compile(rf"{_TOKEN.pattern}(?: {_TOKEN.pattern})*")
_OPEN = {"(": ")", "（": "）", "“": "”", "《": "》", "「": "」", "【": "】", "[": "]"}
_CLOSE = set(_OPEN.values())


def _core(text: str) -> str:
    return _NOT_ALNUM.sub("", unicodedata.normalize("NFKC", text).lower())


class SuffixAutomaton:
    """All substrings of a text, built online; :meth:`coverage` marks what another text shares with it."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for c in text:
            cur = self._state({}, 0, self.length[last] + 1)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = cur
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                if self.length[p] + 1 == self.length[q]:
                    self.link[cur] = q
                else:
                    twin = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = twin
                        p = self.link[p]
                    self.link[q] = self.link[cur] = twin
            last = cur

    def _state(self, edges: dict[str, int], link: int, length: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def coverage(self, text: str, least: int) -> tuple[int, int]:
        """Characters of ``text`` inside shared substrings of ``least`` or more, and the longest such."""
        state = size = longest = covered = upto = 0
        for i, c in enumerate(text):
            while state and c not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if c in self.next[state]:
                state, size = self.next[state][c], size + 1
            longest = max(longest, size)
            if size >= least:
                covered += i + 1 - max(upto, i + 1 - size)
                upto = i + 1
        return covered, longest


def refusal_automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, (wide, latin) in CUES.items():
        for phrase in (*wide, *latin):
            found.add_word(phrase, (kind, phrase))
    for phrase in ELSEWHERE:
        found.add_word(phrase, ("scope", phrase))
    found.make_automaton()
    return found


def is_refusal(automaton: ahocorasick.Automaton, answer: str) -> bool:
    """The answer declines to answer: a cue with its subject and act, in one of the first sentences."""
    text = unicodedata.normalize("NFKC", answer).lower().replace("’", "'")
    for last, (kind, phrase) in automaton.iter(text):
        start, stop = last + 1 - len(phrase), last + 1
        latin = phrase[0].isascii()
        if latin and (text[start - 1 : start].isalnum() or text[stop : stop + 1].isalnum()):
            continue  # inside a word
        if len(_SENTENCE.findall(text, 0, start)) >= DECLINE_WITHIN:
            continue
        clause = _CLAUSE.split(text[:start])[-1]
        if kind == "scope":
            return True
        if kind == "rule":
            if _NOBODY.fullmatch(clause) or _REQUEST.search(clause):
                return True
            continue
        nobody = _NOBODY.fullmatch(clause) and phrase not in IMPERATIVE
        if not (nobody or (_SELF_EN if latin else _SELF_ZH).search(clause)):
            # a request that cannot be answered has the request as its subject
            if not (latin and _REQUEST.search(clause) and re.match(r"\s*be\s+(?:answered|discussed|given)", text[stop:])):
                continue
        if kind == "own" or (_ACT_EN if latin else _ACT_ZH).match(text, stop):
            return True
    return False


def is_empty(answer: str | None) -> bool:
    if answer is None:
        return True
    text = _LABEL.sub("", unicodedata.normalize("NFKC", answer).strip())
    text = text.strip()
    bare = re.sub(r"[\s\W_]+", "", text)
    return not bare or bare.lower() in NOTHING or text.lower().strip(" .。-()[]（）") in NOTHING


def language_votes(text: str) -> Counter:
    """Votes by language: script counts for zh, ja, ko, ru; stopwords for the Latin-script languages."""
    votes: Counter = Counter()
    if not text.isascii():
        han, kana = len(_HAN.findall(text)), len(_KANA.findall(text))
        if kana * 4 > han:
            votes["ja"] = (han + kana) // 2
        else:
            votes["zh"] = han // 2
        votes["ko"], votes["ru"] = len(_HANGUL.findall(text)) // 2, len(_CYRILLIC.findall(text)) // 3
    for w in _WORD.findall(text):
        for lang in _VOTES.get(w.lower(), ()):
            votes[lang] += 1
    return votes


def other_language(question: str, answer: str) -> bool:
    """The answer is in another language than the question; single foreign terms in it do not count."""
    said = _NOTE.sub("", answer)
    asked, given = language_votes(question), language_votes(said)
    of = asked.most_common(1)
    if not of or of[0][1] < 1:
        return False
    lang = of[0][0]
    every = _WORD.findall(said)
    if not given[lang]:
        plain = [w for w in every if len(w) > 1 and (w.islower() or w.lower() in _VOTES)]
        foreign = lang not in STOPWORDS or any(not w.isascii() for w in every)
        if len(plain) >= 4 and foreign:
            return True  # several plain words, none of the question's language
        function = any(w.lower() in _VOTES for w in plain)
        if lang not in STOPWORDS and function and len(plain) >= 2 and not _WIDE.search(said):
            return True  # a short phrase with a function word
        if lang in STOPWORDS and len(_WIDE.findall(said)) >= 2 and said.rstrip()[-1:] in MARKS and not any(w.islower() and w.isascii() and len(w) > 1 for w in every):
            return True  # a short sentence in another script
    if not given:
        return False
    best, n = given.most_common(1)[0]
    return n >= 2 and best != lang and n >= 2 * given.get(lang, 0) + 1


def is_copy(question: str, answer: str, least: int = 4) -> bool:
    """The answer gives back the question and nothing more, apart from a label in front."""
    asked = _core(question)
    given = unicodedata.normalize("NFKC", _NOTE.sub("", answer)).strip()
    given = _core(_ASKED.sub("", _LABEL.sub("", given)))
    if len(asked) < 4 or not given:
        return False
    run = -(-7 * len(asked) // 10)  # every run of so many characters of the question holds its middle
    if asked[len(asked) - run : run] not in given:
        return False
    automaton = SuffixAutomaton(asked)
    covered, longest = automaton.coverage(given, min(least, len(asked)))
    spare = max(2, min(len(given), 2 * len(asked)) // 12)  # characters of its own, however often the question is repeated
    return covered >= len(given) - spare and longest >= 0.7 * len(asked)


def open_delimiters(text: str) -> int:
    """Depth of the delimiter stack at the end of the text."""
    stack: list[str] = []
    for c in text:
        if c in _OPEN:
            stack.append(_OPEN[c])
        elif c in _CLOSE and stack and stack[-1] == c:
            stack.pop()
    return len(stack)


def _masked(text: str) -> str:
    return re.sub(r"\d+", "0", re.sub(r"\b[A-Za-z][a-z]{3,}[a-z_]*\d*\b", "N", text))


def intact(answer: str | None) -> str | None:
    """The answer without its note, if it ends in a sentence mark."""
    text = _NOTE.sub("", answer or "")
    return text if strip_wrapping(text)[2] == "mark" else None


def cut_answers(answer: str) -> list[tuple[str, int, float]]:
    """Training examples of an answer: in answers a sentence without its mark counts as cut."""
    text = intact(answer)
    return make_examples([text], cuts=8, bare_is_whole=False) if text else []


def _fit_shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A model per shard of (shard, answer), sorted by shard; (block, sums): weights times occurrences, and these."""
    sums = np.zeros((2, 1 << BITS), np.int64)

    def learn(answers: list[str]) -> None:
        rows: list[np.ndarray] = []
        labels: list[float] = []
        for answer in answers:
            made: dict[str, np.ndarray] = {}  # an answer's examples repeat
            for text, near, label in cut_answers(answer):
                if text not in made:
                    made[text] = np.array(features(text, near), np.int64)
                rows.append(made[text])
                labels.append(label)
        if rows:
            times = np.bincount(np.concatenate(rows), minlength=1 << BITS)
            slots = np.flatnonzero(times)
            sums[0, slots] += np.rint(fit_slots(rows, np.array(labels))[slots].astype(float) * times[slots] * UNIT).astype(np.int64)
            sums[1] += times

    shard, held = None, []
    for pdf in batches:
        for of, answer in zip(pdf["shard"], pdf["answer"], strict=True):
            if of != shard:
                learn(held)
                shard, held = of, []
            held.append(answer)
    learn(held)
    by_block = sums.reshape(2, -1, BLOCK)
    blocks = np.flatnonzero(by_block[1].any(axis=1))
    for at in range(0, len(blocks), 1_000):
        some = blocks[at : at + 1_000]
        yield pd.DataFrame({"block": some.astype(np.int32), "sums": [by_block[:, k].tobytes() for k in some]})


def _mean_weights(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(block, weights) of all (block, sums) of the blocks that a task has."""
    held: dict[int, np.ndarray] = {}
    for pdf in batches:
        for block, sums in zip(pdf["block"], pdf["sums"], strict=True):
            held[block] = held.get(block, 0) + np.frombuffer(sums, np.int64).reshape(2, BLOCK)
    weights = [(total / np.maximum(n, 1) / UNIT).astype(np.float32).tobytes() for total, n in held.values()]
    yield pd.DataFrame({"block": np.array(list(held), np.int32), "weights": pd.Series(weights, dtype=object)})


def fit_all(answers: DataFrame) -> np.ndarray:
    """Weights of the end model, fitted on every intact one of the distinct ``answers``.

    Answers go to shards by their hash, and a task holds one shard at a time. A feature's weight is the mean of
    those that the shards' models give it, by its occurrences there: it is the same however the rows are split.
    """
    shards = max(1, -(-answers.count() // SHARD_ROWS))
    place = F.xxhash64("answer")
    placed = answers.select(F.pmod(place, F.lit(shards)).alias("shard"), place.alias("place"), "answer")
    parts = table_partitions(answers.sparkSession)
    spread = placed.repartition(parts, "shard").sortWithinPartitions("shard", "place", "answer")
    sums = spread.mapInPandas(_fit_shards, "block int, sums binary").repartition(parts, "block")
    weights = np.zeros(((1 << BITS) // BLOCK, BLOCK), np.float32)
    for row in sums.mapInPandas(_mean_weights, "block int, weights binary").collect():  # 4 MB, fixed by BITS
        weights[row.block] = np.frombuffer(row.weights, np.float32)
    return weights.ravel()


def _lowered(phrase: str) -> str:
    return phrase[:1].lower() + phrase[1:]


class EndModel:
    """Whether an answer breaks off within a sentence; fitted on cut copies of intact answers.

    An answer's sentence without its mark counts as cut, unlike in descriptions, but a short noun phrase does not.
    """

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def broken(self, answer: str) -> tuple[bool, str | None, list[str] | None]:
        """Whether the answer is broken; a short phrase, given with its keys, is so only if :func:`_cut_phrases` confirms it."""
        text = _NOTE.sub("", answer)
        rest, _, ending = strip_wrapping(text)
        if ending == "broken":
            return True, None, None
        if ending == "mark":
            return False, None, None
        if open_delimiters(rest) and text.rstrip() == rest:
            return True, None, None
        keys = []
        tokens = _TOKEN.findall(rest) if len(rest) <= NAME and rest[:1].isupper() else []
        if 0 < len(tokens) <= NAME_WORDS and " ".join(tokens) == rest:
            keys += [f"w{w}" for w in sorted(set(tokens))]
            if len(tokens) > 1:
                keys += [f"b{_lowered(rest)}", f"e{_lowered(rest)}"]
        if len(rest) <= 12 and not any(c in rest for c in MARKS + "，,、；;：:"):
            keys.append(f"h{_masked(rest)[:HEAD]}")
        return probability(self.weights, text, 0) >= 0.5, rest if keys else None, keys or None


def _keys(text: str) -> set[str]:
    """What an intact answer shows of short phrases: its masked heads (h), words (w), and the phrases of several words that it begins with (b) or that end a clause (e)."""
    head = _masked(text)[:HEAD]
    found = {f"h{head[:k]}" for k in range(1, len(head) + 1)}
    for run in _RUN.finditer(text):
        tokens = run[0].split(" ")
        found.update(f"w{w}" for w in tokens if len(w) <= NAME)
        after = text[run.end() : run.end() + 2]
        after = after[1:] if after[:1] == " " else after[:1]
        sizes = range(2, NAME_WORDS + 1)
        if not run.start():
            found.update(f"b{_lowered(x)}" for k in sizes if k < len(tokens) and len(x := " ".join(tokens[:k])) <= NAME)
        if not (after in (" ", "'", "’", "-", "_") or after.isalpha() and after < "\u0250"):
            found.update(f"e{_lowered(x)}" for k in sizes if k <= len(tokens) and len(x := " ".join(tokens[-k:])) <= NAME)
    return found


def _evidence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, n) of the intact ones of the answers (answer, n): how many rows have the key."""
    held: Counter = Counter()

    def handed() -> pd.DataFrame:
        return pd.DataFrame({"key": pd.Series(list(held), dtype=object), "n": pd.Series(list(held.values()), dtype="int64")})

    for pdf in batches:
        for answer, n in zip(pdf["answer"], pdf["n"], strict=True):
            if text := intact(answer):
                for key in _keys(text):
                    held[key] += n
            if len(held) > HELD_KEYS:
                yield handed()
                held.clear()
    yield handed()


def _cut_phrases(asked: DataFrame, answers: DataFrame) -> DataFrame:
    """The phrases among (phrase, keys) that are cut, by all intact answers.

    A phrase is a name, and whole, if over two rows use each of its words, unless several words begin an intact answer
    and end a clause in no more than two. Of the others a short one is cut only if an intact answer begins like it.
    """
    seen = answers.mapInPandas(_evidence, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))
    looked = asked.select("phrase", F.explode("keys").alias("key")).join(seen, "key", "left")
    n = F.coalesce("n", F.lit(0))
    of = lambda kind: F.col("key").startswith(kind)
    votes = looked.groupBy("phrase").agg(
        F.count_if(of("w")).alias("words"), F.count_if(of("w") & (n > 2)).alias("known"), F.count_if(of("b") & (n > 0) | of("e") & (n <= 2)).alias("begins"),
        F.count_if(of("h")).alias("heads"), F.count_if(of("h") & (n > 0)).alias("met"),
    )
    name = (F.col("words") > 0) & (F.col("known") == F.col("words")) & (F.col("begins") < 2)
    return votes.where(~name & (F.col("heads") == F.col("met"))).select("phrase")


def _judge(model: EndModel):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = refusal_automaton()
        for pdf in batches:
            out, phrases, lookups = [], [], []
            for q, a in zip(pdf["question"], pdf["answer"], strict=True):
                defect = phrase = keys = None
                if is_empty(a):
                    defect = "empty"
                elif is_refusal(automaton, a):
                    defect = "refusal"
                elif q and is_copy(q, a):
                    defect = "copy"
                elif q and other_language(q, a):
                    defect = "language"
                else:
                    broken, phrase, keys = model.broken(a)
                    defect = "truncated" if broken else None
                out.append(defect)
                phrases.append(phrase if defect else None)
                lookups.append(keys if defect else None)
            yield pdf[["rec"]].assign(**{k: pd.Series(v, pdf.index, object) for k, v in (("defect", out), ("phrase", phrases), ("keys", lookups))})

    return run


def qa_defects(pairs: DataFrame, rec: str, question: str, answer: str, sample_rows: int | None = None) -> DataFrame:
    """(rec, defect) of every pair; defect is null for a pair that can be used.

    The defects are empty, refusal, copy, language and truncated, tried in this order; a pair gets the first
    that holds. A null or blank question excludes copy and language only. Repeated pairs are judged each and
    a null id is kept. An empty table gives no rows; other columns are not read. Training and counts take every
    answer: ``sample_rows``, which once bounded them, is still accepted and changes nothing.
    """
    rows = pairs.select(
        F.col(rec).cast("long").alias("rec"), F.col(question).cast("string").alias("question"), F.col(answer).cast("string").alias("answer")
    )
    answers = write_out(rows.where("answer is not null").groupBy("answer").agg(F.count("*").alias("n")))
    shared = pairs.sparkSession.sparkContext.broadcast(EndModel(fit_all(answers)))  # weights: bounded by BITS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _judge(shared.value)(batches)

    judged = write_out(rows.mapInPandas(run, "rec long, defect string, phrase string, keys array<string>"))
    phrases = judged.where("phrase is not null")
    cut = _cut_phrases(phrases.select("phrase", "keys").distinct(), answers).withColumn("cut", F.lit(True))
    confirmed = phrases.join(cut, "phrase", "left").select("rec", F.when(F.col("cut"), F.col("defect")))
    return judged.where("phrase is null").select("rec", "defect").union(confirmed)
