"""Line rules on small texts, and clean labelled documents are kept."""

from tests.oracle import DATA
from tickloom.llm.line_rules import line_rules, measure, repeated_words


def test_counts():
    assert measure(None)[:7] == (0, 0, 0, 0, 0, True, False)
    assert measure("")[:7] == (0, 0, 0, 0, 0, True, False)
    text = "one two three four five six, seven eight.\nHome | About | Help\nHome | About | Help\nnine ten eleven."
    chars = sum(map(len, text.split()))
    assert measure(text)[:7] == (21, chars, 4, 1, 10, True, False)
    assert measure(text)[7] == "one two three four five six, seven eight.\nnine ten eleven."


def test_repeats_by_brute_force():
    import random

    rng = random.Random(1)
    for _ in range(200):
        w = rng.choices("abc", k=rng.randrange(40))
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        cover = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
        assert repeated_words(w) == len(cover)


def test_edge_rows(spark):
    rows = [(1, None), (None, "a b"), (1, None), (2, "word " * 300_000), (3, "   \x1c x")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, kept int")
    got = {(r.doc_id, r.n_words, r.kept) for r in line_rules(df).collect()}
    assert got == {(1, 0, False), (None, 2, False), (2, 300_000, False), (3, 3, False)}
    assert line_rules(df.limit(0)).collect() == []


def test_clean_documents_are_kept(spark):
    d = spark.read.parquet(str(DATA / "sf0.01/documents.parquet"))
    labels = spark.read.parquet(str(DATA / "sf0.01/labels.parquet"))
    rows = line_rules(d).join(labels, "doc_id").groupBy("quality").agg({"*": "count"}).collect()
    kept = {r.quality: r for r in line_rules(d).where("kept").join(labels, "doc_id").groupBy("quality").count().collect()}
    total = {r.quality: r["count(1)"] for r in rows}
    assert kept[1]["count"] >= 0.97 * total[1]
    assert kept[0]["count"] <= 0.3 * total[0] if 0 in kept else True


def slow(text):
    """The counts and the verdict, text by text in plain Python."""
    import re

    from tickloom.llm import line_rules as r

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    cover = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    lost = total = dup = 0
    seen, clean = set(), []
    for line in text.split("\n"):
        w = re.findall(r"[^\x20\x09-\x0d]+", line)
        size = sum(map(len, w))
        if not size:
            clean.append(line)
            continue
        dup += line in seen
        seen.add(line)
        total += size
        bad = line.count("|") >= r.BARS or line.count("!!") >= r.SHOUTS or 100 * sum(line.count(c) for c in r.SYMBOLS) > r.SYMBOL_PERCENT * size
        bad = bad or (len(w) >= r.BARE_WORDS and not any(c in line for c in r.PUNCTUATION)) or re.search(r.BOILERPLATE, re.sub("[A-Z]", lambda m: m[0].lower(), line))
        if bad:
            lost += size
        else:
            clean.append(line)
    failed = len(words) < 10 or 100 * len(cover) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in r.SYMBOLS), dup, len(cover), failed, not failed and 100 * lost <= 50 * total, "\n".join(clean)


def test_batches_equal_plain_python(spark):
    import random

    rng = random.Random(7)
    parts = ["a", "bb", "é", "ñandú", "|", "!!", "!!!", "!", "#", "$%", ".", ",", "\n", "\n\n", " ", "\t", "\x1c", "Click Here", "all rights reserved", "licensed\nunder", "日本", "x y z w v", ""]
    texts = [None, "", "\n", "!!\n!!", "a!!b\n!!c!!!!d"] + ["".join(rng.choice(parts) + rng.choice([" ", "", "\n", " "]) for _ in range(rng.randrange(60))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    got = {r.doc_id: tuple(r)[1:] for r in line_rules(df, with_text=True).collect()}
    for i, text in enumerate(texts):
        assert got[i] == slow(text), repr(text)


def test_clean_lines_of_other_scripts_stay():
    clean = [
        "هل وصلت الرسالة الأولى إلى المدينة البعيدة؟\nنعم وصلت في الصباح الباكر، وقرأها الجميع بعد الغداء؛ ثم كتبوا ردا طويلا",
        "今日は 朝から 雨が 降って いました。\n それでも 彼は 遠い 町まで 歩いて いきました。 本当に！",
        "คน ไทย เขียน ประโยค โดย เว้น วรรค ระหว่าง ประโยค และ ไม่ ใช้ จุด",
        "यह पहला वाक्य है और इसका अंत दंड से होता है।\nयह दूसरा वाक्य भी है।",
        "Она пришла домой поздно вечером, когда все уже спали.\nНикто не слышал её шагов.",
    ]
    for text in clean:
        assert measure(text)[5:7] == (False, True) and measure(text)[7] == text, text
    menu = "Главная › Новости › Спорт\nВсе права защищены\n版权所有 二零二零"
    assert measure(menu + "\n" + clean[4])[7] == clean[4]


def test_segments_change_nothing(monkeypatch):
    from tickloom.llm import common, line_rules

    text = "Ünï wörd، ab!! cd!! ef!!\nHome | A | B\nплан на день без точки\nClick here please\n" * 5
    want = measure(text)
    for size in (1, 7, 64):
        monkeypatch.setattr(common, "SEGMENT", size)
        monkeypatch.setattr(line_rules, "SEGMENT", size)
        assert measure(text) == want
