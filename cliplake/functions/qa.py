"""Question and answer pairs out of a model's free text, and the prompt that asks for them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cliplake.functions.text import let, strip

# The words that label questions and answers, with a number and without.
NUMBERED = {"q": ["问题"], "a": ["答案"]}
LOOSE = {"q": ["问题", "问", "Q题", "Q"], "a": ["答案", "答", "A案", "A"]}
COLONS = "：:"
DIGITS = "０１２３４５６７８９"
_MARK = "\x01"  # set around the labels found; one in the text itself is dropped


def _labelled(text: Column, words: dict[str, list[str]], number: str) -> Column:
    """Array of (side, n, label, text): every label of a text in order, with the text up to the next one."""
    either = "|".join(w for side in words.values() for w in side)
    parts = F.split(F.regexp_replace(text, rf"(?U)(?:{either}){number}\s*[{COLONS}]", f"{_MARK}$0{_MARK}"), _MARK)

    def tokens(x: Column) -> Column:
        at = F.filter(F.sequence(F.lit(2), F.greatest(F.size(x["p"]), F.lit(2)), F.lit(2)), lambda k: k < F.size(x["p"]))
        return F.transform(at, lambda k: token(F.element_at(x["p"], k), F.element_at(x["p"], k + 1)))

    def token(label: Column, rest: Column) -> Column:
        asks = F.lit(False)
        for w in words["q"]:
            asks = asks | label.startswith(w)
        n = F.translate(F.regexp_extract(label, r"(?U)(\d+)", 1), DIGITS, "0123456789").try_cast("long")
        return F.struct(F.when(asks, "q").otherwise("a").alias("side"), n.alias("n"), label.alias("label"), rest.alias("text"))

    return let(tokens, p=parts)


def _bodies(tokens: Column, side: str, any_stops: bool) -> Column:
    """Array of (n, body) of one side's labels, in order.

    A body runs to the next label of the other side, or of any side. It has at least one character: a label
    right behind another, white space aside, is taken as the body's beginning.
    """
    kind = "struct<done:array<struct<n:bigint,body:string>>,open:boolean,n:bigint,body:string>"
    start = F.struct(F.array().alias("done"), F.lit(False).alias("open"), F.lit(None).alias("n"), F.lit("").alias("body")).cast(kind)
    state = lambda done, open_, n, body: F.struct(done.alias("done"), open_.alias("open"), n.alias("n"), body.alias("body")).cast(kind)
    closed = lambda s: F.concat(s["done"], F.array(F.struct(s["n"].alias("n"), s["body"].alias("body"))))

    def step(s: Column, t: Column) -> Column:
        own = t["side"] == side
        stops = F.lit(True) if any_stops else ~own
        whole = F.concat(t["label"], t["text"])
        fresh = state(F.when(s["open"], closed(s)).otherwise(s["done"]), own, F.when(own, t["n"]), F.when(own, t["text"]).otherwise(F.lit("")))
        return F.when(s["open"] & (strip(s["body"]) == ""), state(s["done"], s["open"], s["n"], whole)).when(s["open"] & ~stops, state(s["done"], s["open"], s["n"], F.concat(s["body"], whole))).otherwise(fresh)

    finish = lambda s: F.transform(F.when(s["open"] & (s["body"] != ""), closed(s)).otherwise(s["done"]), lambda x: F.struct(x["n"].alias("n"), strip(x["body"]).alias("b")))
    return F.aggregate(tokens, start, step, finish)


def parse_pairs(text: Column) -> Column:
    """Array of (question, answer) structs of a response.

    Numbered pairs first: of a number given twice the last counts, numbers on both sides only, in order,
    blanks dropped. If there is none, loose labels are zipped in order. A null text gives an empty array.
    """
    text = F.translate(F.coalesce(text, F.lit("")), _MARK, "")

    def numbered(x: Column) -> Column:
        last = lambda items, n: F.try_element_at(F.filter(items, lambda y: y["n"] == n), F.lit(-1))["b"]
        both = F.array_sort(F.array_intersect(F.transform(x["q"], lambda y: y["n"]), F.transform(x["a"], lambda y: y["n"])))
        known = F.filter(both, lambda n: n.isNotNull())
        return _whole(F.transform(known, lambda n: F.struct(last(x["q"], n).alias("question"), last(x["a"], n).alias("answer"))))

    def loose(x: Column) -> Column:
        size = F.least(F.size(x["q"]), F.size(x["a"]))
        zipped = F.arrays_zip(F.slice(x["q"], F.lit(1), size).alias("q"), F.slice(x["a"], F.lit(1), size).alias("a"))
        return _whole(F.transform(zipped, lambda y: F.struct(y["q"]["b"].alias("question"), y["a"]["b"].alias("answer"))))

    def sides(words: dict[str, list[str]], number: str, any_stops: bool, body) -> Column:
        both = lambda x: let(body, q=_bodies(x["t"], "q", any_stops), a=_bodies(x["t"], "a", any_stops))
        return let(both, t=_labelled(text, words, number))

    first = sides(NUMBERED, r"\s*\d+", True, numbered)
    other = sides(LOOSE, "", False, loose)
    return let(lambda x: F.when(F.size(x["found"]) > 0, x["found"]).otherwise(other), found=first)


def _whole(items: Column) -> Column:
    return F.filter(items, lambda x: (x["question"] != "") & (x["answer"] != ""))


def qa_prompt(description: Column, questions: int = 4) -> Column:
    """The prompt for ``questions`` pairs about a description, with as many answer slots."""
    ask = (
        f"请根据下面的视频片段描述，提出 {questions} 个与游戏理解有关的问题并逐一作答。\n"
        "问题与答案只能依据描述中的内容，答案用 1–3 句话。\n请严格按以下格式输出：\n"
    )
    slots = "\n\n".join(f"问题{k}：<问题>\n答案{k}：<答案>" for k in range(1, questions + 1))
    return F.concat(F.lit(ask + slots + "\n\n【视频描述】\n"), description)
