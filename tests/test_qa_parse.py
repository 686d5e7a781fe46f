import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from checks import same
from pyspark.sql import functions as F

from cliplake.functions.qa import parse_pairs
from cliplake.plans import table_queries as P

PAIRS = [
    ("武器？", "AWP"), ("武器？", "问题：武器？"), ("武器？", "答案：AWP"), ("武器？", "答案2：AWP"), ("武器？", "AWP\n问题1：地点？\n答案1：中路"), ("Q: who?", "A: Bo"), ("问题 7 : 谁", "Bo 答案7：Al 答案 7：Cy"),
    ("问题1：", "答案1："), ("FAQ: x", "see Q&A: y\nA: z"), ("问？", "答案９：宽"), ("问题5：a", "答案5：答案5：b"), ("x", "问题"), ("", "a"), ("q", None), (" 　", "a"), ("武器？", "  AWP \n "), ("a", "问题12345678901234567890：b答案12345678901234567890：c"),
]


def scan(text, label, side_of, any_stops):
    """Bodies by side, by walking over the text one label at a time."""
    hits = [(m.start(), m.end(), side_of(m[0]), int((re.search(r"\d+", m[0]) or ["-1"])[0])) for m in re.finditer(label, text)]
    found = {"q": [], "a": []}
    for side in found:
        at = 0
        for start, end, own, n in hits:
            if own != side or start < at:
                continue
            first = end
            while first < len(text) and text[first].isspace():
                first += 1
            at = min((s for s, _, other, _ in hits if s > first and (any_stops or other != side)), default=len(text))
            if end < at:
                found[side].append((n, text[first:at].strip()))
    return found


def brute(text):
    told = scan(text, r"(?:问题|答案)\s*\d+\s*[：:]", lambda x: "q" if x.startswith("问") else "a", True)
    q, a = dict(told["q"]), dict(told["a"])
    numbered = [(q[n], a[n]) for n in sorted(q.keys() & a.keys()) if n < 2**63 and q[n] and a[n]]
    told = scan(text, r"(?:[问Q]题?|[答A]案?)\s*[：:]", lambda x: "q" if x[0] in "问Q" else "a", False)
    return numbered or [(x, y) for (_, x), (_, y) in zip(told["q"], told["a"], strict=False) if x and y]


@pytest.mark.parametrize(
    ("name", "made"),
    [
        ("qa_parse_numbered", lambda q, a: f"问题2：{q}\n答案2：{a}\n问题1:第一\n答案 1 : {a}\n问题3：{q}"),
        ("qa_parse_loose", lambda q, a: f"问：{q}\n答：{a}\nQ: {q}\n"),
    ],
)
def test_pairs_with_labels_are_parsed_too(spark, tmp_path, name, made):
    ids, questions, answers = range(len(PAIRS)), *zip(*PAIRS, strict=True)
    pq.write_table(pa.table({"qa_id": list(ids), "question": list(questions), "answer": list(answers)}), tmp_path / "clip_qa_pairs.parquet")
    wanted = [(k, at, *p) for k, (q, a) in enumerate(PAIRS) if q.strip() and a and a.strip() for at, p in enumerate(brute(made(q, a)))]
    assert sorted(map(tuple, P.QUERIES[name](spark, str(tmp_path)).collect())) == wanted
    same(spark, str(tmp_path), P.QUERIES[name], P.SQL[name])


def test_any_order_of_labels(spark):
    rng = random.Random(3)
    bits = ["问题1：", "问题 2:", "答案1：", "答案２ ：", "问：", "Q:", "答：", "A案: ", "x", " ", "\n", "中", "问题", "9", "：", "\x01"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 12))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    got = {r.k: [tuple(p) for p in r.p] for r in df.select("k", parse_pairs(F.col("t")).alias("p")).collect()}
    for k, t in enumerate(texts):
        assert got[k] == brute(t.replace("\x01", "")), t
