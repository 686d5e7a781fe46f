import random

import pytest

from cliplake.llm import qadefects as Q
from cliplake.llm import truncation as R

PLACES = ["中路", "天台", "集装箱顶", "B洞口", "长廊尽头", "警家"]
GUNS = ["AK-47", "AWP", "Glock", "M4A1-S", "P90"]
NAMES = ["Mexgrutus6", "Nukransol72", "Lixzennav", "Dapivonuk", "Yolchtdex"]


def sentence(rng):
    p, q, g, n = rng.choice(PLACES), rng.choice(PLACES), rng.choice(GUNS), rng.choice(NAMES)
    return rng.choice(
        [
            f"{n}从{p}悄悄推进到{q}，手持{g}，拿下首杀。",
            f"第{rng.randrange(30)}回合，匪方的{n}选择在{p}架枪，等待狙击手露头。",
            f"{n}在烟雾边缘反复试探{p}，最终以{g}守住了包点。",
            f"这波闪光弹落点略偏，只封住了{p}的一半视野。",
            f"{n} throws a smoke at the {rng.choice(['crates', 'garage', 'archway'])} and switches to the {g}.",
            f"On the way back {n} meets the sniper near the {rng.choice(['crates', 'garage'])} and gets the opening kill.",
        ]
    )


def text(rng, n=4):
    return "".join(s + (" " if s.isascii() else "") for s in (sentence(rng) for _ in range(n))).strip()


def test_held_out_accuracy():
    rng = random.Random(1)
    weights = R.fit(R.make_examples([text(rng) for _ in range(700)]))
    held = R.make_examples([text(rng) for _ in range(200)], seed=99)
    right = [(R.probability(weights, t, k) >= 0.5) == (y == 1) for t, k, y in held]
    assert sum(right) / len(right) > 0.96


@pytest.mark.parametrize(
    ("raw", "rest", "omitted", "ending"),
    [
        ("走。", "走。", False, "mark"), ("走。👍", "走。", False, "mark"), ("（走。）", "（走。", False, "mark"), ("走。 #残局", "走。", False, "mark"), ("走…", "走", True, "open"), ("go...", "go", True, "open"),
        ("走�", "走", False, "broken"), ("走", "走", False, "open"), ("", "", False, "open"), ("...", "", True, "open"), ("”", "", False, "open"),
    ],
)
def test_wrapping(raw, rest, omitted, ending):
    assert R.strip_wrapping(raw) == (rest, omitted, ending)


def test_a_delimiter_opened_long_ago_counts():
    opened, closed = "他说（" + "走" * 300, "他说" + "走" * 300
    assert len(R.features(opened, 0)) == len(R.features(closed, 0)) + 1


DDL = "src string, rec long, text string, source_file string, probability double, n long"


def test_truncated_records(spark):
    rng = random.Random(2)
    rows = [("clip", k, text(rng), "a.jsonl") for k in range(400)]
    rows += [("clip", 1000 + k, text(rng)[:-1], "a.jsonl") for k in range(20)]  # whole but for the mark
    cut = []
    for k in range(60):
        t = text(rng)
        at = rng.randrange(len(t) // 2, len(t) - 4)
        while t[at - 1] in "。.， " or t[at] in "。. ":
            at -= 1
        cut.append(("clip", 2000 + k, t[:at] + rng.choice(["", "…", "..."]), "b.jsonl"))
    odd = [("clip", 3000, None, "a.jsonl"), ("clip", 3001, " 　", "a.jsonl"), ("clip", 3002, "...", None), ("clip", 3003, text(rng, 2000), None), (None, None, text(rng), None), rows[0]]
    df = spark.createDataFrame([(*r, 0.0, 0) for r in rows + cut + odd], DDL)
    got = R.truncated(df).collect()
    by = {r.rec: r.probability for r in got}
    assert not {3000, 3001, 3002} & set(by) and None in by and sum(r.rec == 0 for r in got) == 2
    assert sum(by[r[1]] >= 0.5 for r in rows) <= 6
    assert sum(by[r[1]] >= 0.5 for r in cut) >= 54
    assert R.truncated(df.where("false")).count() == 0


def test_sample_has_every_source_and_the_whole_table(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(R, "fit_sample", lambda sample, examples, make=R.fit_sample: seen.extend(r.text for r in sample.collect()) or make(sample, examples))
    rows = [("clip", k, f"clip {k} went on.", "a") for k in range(300)] + [("pair", k, f"pair {k} went on.", "b") for k in range(100)]
    df = spark.createDataFrame([(*r, 0.0, 0) for r in rows], DDL).repartition(4)
    assert R.truncated(df, sample_rows=80).count() == 400
    clips, pairs = ([int(t.split()[1]) for t in seen if t.startswith(s)] for s in ("clip", "pair"))
    assert len(seen) == len(set(seen)) == 80
    assert 8 <= len(pairs) <= 32 and max(clips) >= 250 and max(pairs) >= 75


def test_limits_are_pile_ups_of_open_ends(spark):
    rng = random.Random(4)
    rows = [("clip", k, "x" * rng.randrange(80, 240), "a") for k in range(800)] + [("clip", k, ("走一步" * 60)[:120], "a") for k in range(60)]
    rows += [("clip", k, "y" * 199 + ".", "b") for k in range(60)] + [("clip", k, "z" * 150, "b") for k in range(3)] + [("clip", 1, "w" * 300, "c"), ("clip", 2, "...", "b")]
    df = spark.createDataFrame([(*r, 0.0, 0) for r in rows], DDL)
    limits = R.source_limits(df).select("source_file", "unit", "length").collect()
    # copies that end whole, a few equal lengths and a lone longest value are no limit
    assert sorted(map(tuple, limits)) == [("a", "b", 360), ("a", "c", 120)]
    wanted = {(r[1], r[2]): R.nearness(r[2], [120], [360]) if r[3] == "a" else 0 for r in rows}
    for most in (10, 0):  # broadcast, and joined by salted keys
        got = R.with_nearness(df.drop("probability", "n"), R.write_out(R.source_limits(df)), most).collect()
        assert len(got) == len(rows) and all(r.near == wanted[r.rec, r.text] for r in got)


def test_the_longest_value_of_a_source_is_no_evidence(spark):
    rng = random.Random(9)
    texts = [text(rng) for _ in range(300)]
    rows = [("clip", k, t, "a") for k, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, 0.0, 0) for r in rows + [("clip", 900, texts[0] * 3, "b"), ("clip", 901, texts[0] * 3, "a")]], DDL)
    by = {r.rec: r.probability for r in R.truncated(df).where("rec >= 900").collect()}
    assert by[900] == by[901] < 0.1


def test_cuts_at_limits():
    assert R.cut_at("走一步看", "c", 2) == "走一" and R.cut_at("走一步看", "b", 7) == "走一�" and R.cut_at("走", "c", 1) is None
    made = R.make_examples(["abc defg hijk lmnop. qrst uvw xyz."], limits=[("c", 12, 3)], limited=1.0)
    assert {(t, k) for t, k, y in made if y == 1} == {("abc defg hij", 2)}


def test_no_intact_value_gives_no_opinion(spark):
    df = spark.createDataFrame([("clip", 1, "no mark", "a", 0.0, 0)], DDL)
    assert [r.probability for r in R.truncated(df).collect()] == [0.5]


@pytest.mark.parametrize("answer", [None, "", " 　\n", "。", "-", "……", "N/A", "None", "null", "无", "答案：", "Answer: ", "答案：无", "暂无"])
def test_empty_answers(answer):
    assert Q.is_empty(answer)


@pytest.mark.parametrize("answer", ["AWP", "no", "无人生还", "3"])
def test_short_answers_are_not_empty(answer):
    assert not Q.is_empty(answer)


@pytest.mark.parametrize(
    ("question", "answer", "copied"),
    [
        ("他用了什么武器？", "他用了什么武器？", True),
        ("他用了什么武器？", "问题：他用了什么武器？", True),
        ("他用了什么武器？", "您问的是，他用了什么武器？", True),
        ("他用了什么武器？", "他用了什么武器？他用了什么武器？", True),
        ("这一回合开始的时候守在中路集装箱后面的那位选手为什么没有提前把烟雾弹扔到长廊的尽头去掩护队友推进呢？", "这一回合开始的时候守在中路集装箱后面的那位选手为什么没有提前把烟雾弹扔到长廊的尽头去掩护队友推进呢？" * 3, True),
        ("Which weapon does Bo use?", "YOU ASKED: WHICH WEAPON DOES BO USE", True),
        ("他从中学到什么？", "他从中学到什么：可以学到先听脚步。", False),
        ("Which weapon does Bo use?", "Bo uses the AWP.", False),
        ("", "x", False),
    ],
)
def test_copies(question, answer, copied):
    assert Q.is_copy(question, answer) == copied


def test_suffix_automaton_equals_brute_force():
    rng = random.Random(6)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(1, 12))) for _ in range(2))
        covered = set()
        longest = 0
        for i in range(len(b)):
            for j in range(i + 1, len(b) + 1):
                if b[i:j] in a:
                    longest = max(longest, j - i)
                    if j - i >= 3:
                        covered |= set(range(i, j))
        assert Q.SuffixAutomaton(a).coverage(b, 3) == (len(covered), longest)


@pytest.mark.parametrize(
    ("question", "answer", "other"),
    [
        ("他在哪里？", "He stays at the archway and waits for the rotation.", True),
        ("Where is he?", "他在天台架枪。", True),
        ("他在哪里？", "Он ждёт на крыше и держит длину.", True),
        ("他在哪里？", "屋上で敵を待っている。", True),
        ("他在哪里？", "AWP", False), ("Where is he?", "中路", False), ("Where is he?", "B洞口", False),
        ("What gun is it?", "他用AK。", True), ("玩家用什么武器？", "An AK-47 rifle.", True), ("Which weapon does the player use?", "AK-47を使う。", True),
        ("他在哪里？", "SG 553 and AWP", False),
        ("他在哪里？", "Weil zu früh nachgeladen wurde, verliert Vunostyrt9 75 Lebenspunkte.", True),
        ("What is the main mistake of Bo?", "Após ouvir passos, recua logo.", True),
        ("他在哪里？", "他在B洞口，手持AK-47。（术语：entry、lurk）", False),
        ("What can a player learn from this?", "The clip shows that you should set up a crossfire. (callout: 中路)", False),
        ("What is the main mistake of Bo?", "Weil zu früh nachgeladen wurde, ist das Spiel nicht mehr zu gewinnen.", True),
    ],
)
def test_other_language(question, answer, other):
    assert Q.other_language(question, answer) == other


@pytest.mark.parametrize(
    "answer",
    [
        "I'm sorry, but I can’t help with that.", "I apologize, but I'm not able to view the video you mentioned.", "As an AI, I cannot provide an answer to this.", "This question cannot be answered by me.",
        "Sorry, this is beyond my capabilities.", "Unfortunately, I am unable to assist with this request.", "I must decline to answer this.", "I don't have access to that clip.", "I refuse to discuss this.",
        "抱歉，作为AI我无法观看这段视频。", "很抱歉，我不能提供该信息。", "我没办法回答您的提问。", "该请求违反了使用政策。", "对不起，这个我帮不了您。", "Lo siento, no puedo responder a eso.", "お答えできません。",
    ],
)
def test_refusals(answer):
    assert Q.is_refusal(Q.refusal_automaton(), answer)


@pytest.mark.parametrize(
    "answer",
    [
        "Dali cannot see the enemy because of the smoke", "Magi can't hold B alone", "He violates the crosshair placement rule", "stands outside my view", "敌人被烟雾挡住，无法访问A点的视野",
        "I cannot hold B alone, so I rotate.", "他不能回答队友的呼叫，因为语音坏了。", "The player is unable to help his teammate.", "队友无法提供帮助，所以他独自回防。", "我不能再压枪了，换弹。", "Do not answer the AWP peek.",
        "They do not access the B site.", "His canthook is cantilevered.", "他先拿下首杀。然后架枪。最后他说我无法回答。",
    ],
)
def test_answers_about_what_players_cannot_do_are_no_refusals(answer):
    assert not Q.is_refusal(Q.refusal_automaton(), answer)


@pytest.mark.parametrize(("times", "copied"), [(1, True), (3, True), (4, True), (40, True)])
def test_copies_of_any_length(times, copied):
    asked = "Which weapon does the player use?"
    assert Q.is_copy(asked, " ".join([asked] * times)) == copied and not Q.is_copy(asked, " ".join([asked] * times) + " The player uses the AWP, then the rifle of a teammate who is down.")


def test_copy_prefilter_is_exact(monkeypatch):
    rng = random.Random(2)
    for _ in range(400):
        asked = "".join(rng.choice("abcd") for _ in range(rng.randrange(4, 20)))
        at = rng.randrange(len(asked))
        given = asked[at:] + "".join(rng.choice("abcd") for _ in range(rng.randrange(0, 4))) + asked[: rng.randrange(len(asked) + 1)]
        covered, longest = Q.SuffixAutomaton(asked).coverage(given, 4)
        assert Q.is_copy(asked, given) == (covered >= len(given) - max(2, min(len(given), 2 * len(asked)) // 12) and longest >= 0.7 * len(asked))


PAIRS = "qa_id long, question string, answer string, defect string, rec long"


def test_defects(spark):
    rng = random.Random(3)
    chinese = [t for t in (text(rng, 2) for _ in range(900)) if not Q.other_language("请说明这个残局如何处理。", t)]
    rows = [(k, "请说明这个残局如何处理。", t) for k, t in enumerate(chinese[:300])]
    odd = {
        1000: ("q？", None, "empty"), 1001: ("它起到了什么作用？", "对不起，我无法回答这个问题。", "refusal"), 1002: ("What is it?", "I'm sorry, but I can’t help with that.", "refusal"),
        1003: ("这个片段用了什么武器？", "这个片段用了什么武器", "copy"), 1004: ("他在哪里？", "He stays at the garage and waits for the others to come.", "language"),
        1005: ("它起到了什么作用？", "这波闪光弹落点略偏，只封住了中路的一", "truncated"), 1006: ("用了什么武器？", "AWP", None), 1007: (None, text(rng, 2), None), 1008: ("　", "", "empty"),
        1009: ("它起到了什么作用？", "抱歉的是，这波闪光弹落点略偏，只封住了中路的一半视野。", None), 1010: ("q？", "".join(chinese), None),
    }
    rows += [(k, q, a) for k, (q, a, _) in odd.items()] + [(None, "q？", ""), rows[0]]
    df = spark.createDataFrame([(*r, "old", 5) for r in rows], PAIRS)
    got = Q.qa_defects(df, "qa_id", "question", "answer").collect()
    by = {r.rec: r.defect for r in got}
    assert len(got) == len(rows) and by[None] == "empty"
    assert {k: by[k] for k in odd} == {k: d for k, (_, _, d) in odd.items()}
    assert sum(by[k] is not None for k in range(300)) <= 3
    assert Q.qa_defects(df.where("false"), "qa_id", "question", "answer").count() == 0


def test_short_cut_answers_whose_full_form_is_in_no_sample(spark):
    rng = random.Random(8)
    rows = [(k, "它起到了什么作用？", "第" + "".join(rng.sample("甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉", 8)) + "之后" + rng.choice(PLACES) + "的一半视野被封住了。") for k in range(600)]
    cut = [(1000 + k, q, a[:9]) for k, q, a in rows[:300:15]]
    whole = [(2000, "它在哪里？", "中路左侧"), (2001, "它在哪里？", "天台")]
    df = spark.createDataFrame([(*r, "old", 5) for r in rows + cut + whole], PAIRS)
    by = {r.rec: r.defect for r in Q.qa_defects(df, "qa_id", "question", "answer", sample_rows=60).collect()}
    assert len(by) == 622 and [by[k] for k, *_ in cut] == ["truncated"] * len(cut)
    assert by[2000] is None and by[2001] is None


def test_names_and_beginnings_count_over_all_answers(spark):
    rng = random.Random(12)
    filler = [(k, "它起到了什么作用？", f"第{k}回合，这波闪光弹落点略偏，只封住了{rng.choice(PLACES)}的一半视野。") for k in range(4500)]
    names = ["".join(rng.choice("abcdefghij") for _ in range(15)).capitalize() for _ in range(30)]
    used = [(5000 + 3 * k + j, "谁在防守？", f"{p}由{n}架枪，队友负责补枪。") for k, n in enumerate(names) for j, p in enumerate(PLACES[:3])]
    english = [(6000 + k, "What is it?", f"{rng.choice(NAMES)} throws a smoke at the upper garage.") for k in range(40)]
    asked = [(7000 + k, "谁在防守？", n) for k, n in enumerate(names)] + [(8000, "谁在防守？", "Onceonlynamed")]
    asked += [(8001, "What is it?", "Yolchtdex throws"), (8002, "What is it?", "Mexgrutus6 throws a"), (8003, "What is it?", "The upper garage"), (8004, "谁在防守？", "SG 553 AWP")]
    used += [(9000 + k, "谁在防守？", f"{w}在{p}。") for k, (w, p) in enumerate((w, p) for w in ("SG 553", "AWP", "The") for p in PLACES[:3])]
    df = spark.createDataFrame([(*r, "old", 5) for r in filler + used + english + asked], PAIRS)
    by = {r.rec: r.defect for r in Q.qa_defects(df, "qa_id", "question", "answer").collect()}
    assert [by[7000 + k] for k in range(30)] == [None] * 30
    assert [by[k] for k in range(8000, 8005)] == ["truncated", "truncated", "truncated", None, None]


@pytest.mark.parametrize(
    ("text", "has", "has_not"),
    [
        ("Bo meets SG 553 at the upper garage.", ["wSG", "bbo meets", "bbo meets SG", "eupper garage", "ethe upper garage", "hBo N"], ["eat the", "bmeets SG"]),
        ("手持SG 553 守点，他说go on。", ["esG 553", "ego on", "w553"], ["bsG 553"]),
        ("He is on the player's side.", ["bhe is", "bhe is on"], ["ethe player", "eon the player"]),
        ("Go now.", ["ego now"], ["bgo now"]),
    ],
)
def test_keys_of_an_answer(text, has, has_not):
    keys = Q._keys(text)
    assert set(has) <= keys and not keys & set(has_not)


def test_end_model_learns_from_every_answer(spark, monkeypatch):
    monkeypatch.setattr(Q, "SHARD_ROWS", 40)
    rng = random.Random(13)
    answers = sorted({text(rng, 2) for _ in range(500)})
    df = spark.createDataFrame([(t,) for t in answers], "answer string")
    weights = Q.fit_all(df.repartition(1))
    assert (weights == Q.fit_all(df.repartition(7))).all()
    assert all((weights[R.features(t, near)] != 0).all() for a in answers for t, near, _ in Q.cut_answers(a))
    held = [x for _ in range(200) for x in Q.cut_answers(text(rng, 2))]
    assert sum((R.probability(weights, t, near) >= 0.5) == (y == 1) for t, near, y in held) / len(held) > 0.99
    assert not Q.fit_all(df.where("false")).any()


def test_delimiters():
    assert Q.open_delimiters("（a") == 1 and Q.open_delimiters("（a）") == 0 and Q.open_delimiters("“a（b”") == 2
