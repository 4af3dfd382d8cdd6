"""Token counts, packing and token files against the library, text by text."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tickloom.llm.packing import pack, packed_sequences
from tickloom.llm.pfor import decode_blocks, encode_blocks, token_files
from tickloom.llm.token_counts import token_counts
from tickloom.llm.tokens import LONG, Pieces

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, "a<|endoftext|> b", "don't I'll 'd 'S 'RE", "ΣΑΣ İx", "x \x85 y z", "héllo  \n\n wör ld 12 3½", "ﬁ é ẛ", "日本語 text", "\x1c a\x1db", "ŉa ſ µ ª º ²³", "a\xadb \x01 c", "x" * 200_000, ("ab cd\n" * 40_000) + "日本", "ab, é 12 " * 30_000, " lead", "trail ", "\n", "a\n\nb", "tab\tb\r\nc", "a b\n c"]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_pieces_equal_the_library(path):
    tk, p = Tokenizer.from_file(path), Pieces(path)
    rng = random.Random(1)
    chars = [chr(c) for c in [9, 10, 13, *range(0x20, 0x7F), *range(0xA0, 0x180)]]
    texts = ODD + [f"a{c}b {c} {c}{c} x'{c} {c}1" for c in chars] + ["".join(rng.choices(chars, k=60)) for _ in range(400)]
    want = [tk.encode(x or "", add_special_tokens=False).ids for x in texts]
    assert list(p.counts(texts)) == list(map(len, want))
    ids, sizes = p.encode(texts)
    assert list(sizes) == list(map(len, want)) and list(ids) == [i for x in want for i in x]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_parts_join_to_the_text(path):
    text, cut = "word one\ntwo " * 50_000, Pieces(path).parts
    assert "".join(cut(text, 1000)) == text and max(map(len, cut(text, 1000))) < 1100


def _letters(first, last, space=" "):
    rng = random.Random(first)
    letters = [chr(c) for c in range(first, last + 1) if chr(c).isprintable() and not chr(c).isspace()]
    return lambda n: space.join("".join(rng.choices(letters, k=rng.randrange(2, 9))) for _ in range(n // 6))[:n]


#: Texts of a script or form, by number of characters; blocks of Unicode stand for scripts.
FORMS = {
    "Bengali": _letters(0x0985, 0x09B9), "Bengali with marks": _letters(0x0980, 0x09FE), "Tamil": _letters(0x0B80, 0x0BFA), "Georgian": _letters(0x10D0, 0x10FF), "Armenian": _letters(0x0531, 0x0587),
    "Amharic": _letters(0x1200, 0x137C), "Khmer": _letters(0x1780, 0x17E9, ""), "Devanagari": _letters(0x0900, 0x097F), "Hangul parts": _letters(0x1100, 0x11FF), "Greek": _letters(0x0370, 0x03FF), "marks": _letters(0x0300, 0x036F),
    "digits": lambda n: ("123 456 " * (n // 8)), "digits alone": lambda n: "1234567890" * (n // 10), "csv": lambda n: "".join(f"{i % 977},{i % 31}\r\n" for i in range(n // 8)), "tabs": lambda n: "wort\tund\tweiß\t" * (n // 14),
    "emoji": lambda n: "😀 👍🏽\t" * (n // 5), "emoji alone": lambda n: "".join(random.Random(3).choices("😀👍🏽🎉🚀🌍", k=n)), "contractions": lambda n: "a'swordsword12words'll" * (n // 21), "special": lambda n: "x<|endoftext|>é1" * (n // 16),
}
#: Runs that are one piece for the tokenizer, in which any tokens may meet.
WHOLE = {WORD: {"emoji alone", "marks"}, BYTE: {"digits alone"}}


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("form", FORMS)
def test_long_texts_of_every_form_are_cut(path, form):
    text, p = FORMS[form](1 << 20), Pieces(path)
    parts = list(p.parts(text))
    assert "".join(parts) == text
    if form not in WHOLE[path]:
        assert max(map(len, parts)) < 2 * LONG
    some = FORMS[form](20_000)
    assert [i for x in p._encode(list(p.parts(some, 500))) for i in x] == p._encode([some])[0]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_cuts_at_every_pair_are_safe(path):
    """Random texts of hard characters cut at every place that is said to be safe."""
    p, rng = Pieces(path), random.Random(9)
    chars = [*"aZ1 \t\n'’.,<|>_-", "é", "e\u0301", "\u0301", "ß", "İ", "ſ", "中", "あ", "が", "か\u3099", "한", "\u1112", "\u1161", "\u11ab", "ก", "ำ", "क", "ि", "\u093c", "\u09c7", "\u09be", "😀", "🏽", "\u200d", "\xa0", "\x85", "\x1c", "²", "½", "Ⅷ", "<|endoftext|>"]
    for _ in range(1500):
        text = "".join(rng.choices(chars, k=rng.randrange(2, 40)))
        parts = list(p.parts(text, 2))
        assert "".join(parts) == text
        assert [i for x in p._encode(parts) for i in x] == p._encode([text])[0], (text, parts)


def frame(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(f"wo{rng.randrange(999)}" for _ in range(rng.choice([0, 3, 50, 4000])))) for i in range(80)]
    docs += [(100 + i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (7, "same id again")]
    return docs, spark.createDataFrame([(*d, 3) for d in docs], "doc_id long, text string, start int").repartition(3)


def test_counts(spark):
    docs, df = frame(spark)
    tk = Tokenizer.from_file(BYTE)
    want = sorted(((i, len((t or "").encode()), n := len(tk.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in docs), key=str)
    assert sorted(map(tuple, token_counts(df, BYTE).collect()), key=str) == want
    assert token_counts(df.limit(0), BYTE).collect() == []


def test_packing(spark):
    docs, df = frame(spark)
    tk = Tokenizer.from_file(WORD)
    rows = packed_sequences(df, WORD, block_ids=20_000, with_ids=True).collect()
    want = sorted((str(i), tuple(tk.encode(t or "", add_special_tokens=False).ids) + (1,)) for i, t in docs)
    groups, sequences = {}, {}
    for r in rows:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        groups.setdefault((str(r.doc_id), r.doc_tokens), []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert sorted((k[0], k[1]) for k in groups) == sorted((i, len(x)) for i, x in want)
    for (i, n), parts in groups.items():
        joined = tuple(x for r in sorted(parts, key=lambda r: r.start) for x in r.ids)
        assert (i, joined) in want and len(joined) == n
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == list(np.cumsum([0, *(r.length for r in parts)])[:-1]) and sum(r.length for r in parts) <= 2048
    assert len(sequences) <= -(-sum(r.length for r in rows) // 2048) + 60
    assert packed_sequences(df.limit(0), WORD).collect() == []


def test_pack_wastes_under_one_sequence_and_balances():
    rng = random.Random(4)
    sizes = np.array([rng.randrange(1, 900) for _ in range(400)])
    found = pack(sizes, 1000)
    total = {}
    for _, _, n, s, _ in found:
        total[s] = total.get(s, 0) + n
    assert sum(total.values()) == sizes.sum() and len(total) == -(-sizes.sum() // 1000)


def test_token_files(spark):
    docs, df = frame(spark)
    tk = Tokenizer.from_file(WORD)
    at = 0
    rows = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files(df, WORD, files=4).collect()))
    ids = {}
    for i, t in docs:
        ids.setdefault(i, set()).add(tuple(tk.encode(t or "", add_special_tokens=False).ids) + (1,))
    assert [r[1] for r in rows] == sorted((i for i, _ in docs), key=lambda x: (x is not None, x))
    for start, i, n, crc in rows:
        assert start == at and any(len(x) == n and zlib.crc32(np.array(x, "<u4").tobytes()) == crc for x in ids[i])
        at += n
    assert token_files(df.limit(0), WORD).collect() == []


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_blocks(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 49408, n), rng.integers(0, 1 << 32, n), np.full(n, 7), np.where(rng.random(n) < 0.05, 1 << 31, rng.integers(5, 9, n))):
        ids = ids.astype(np.uint32)
        assert np.array_equal(decode_blocks(*encode_blocks(ids), n), ids)


SCRIPTS = {"Cyrillic": ("абвгдежзиклмнопрстуёЯ", " ", ", ."), "Chinese": ("的一是不了人我在有他這中大來上國", "", "，。、！"), "Arabic": ("ابتثجحخدذرزسشصضطعغفقكلمنهوي", " ", "،؛؟."), "Thai": ("กขคงจฉชซญฐณดตถทนบปผพฟมยรลวสหอ", " ", ""), "Japanese": ("あいうえおかきくけこ日本語カキクケコ", "", "。、「」")}


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("script", SCRIPTS)
def test_long_texts_of_every_script_are_split(path, script):
    letters, space, signs = SCRIPTS[script]
    rng = random.Random(4)
    text = "".join("".join(rng.choices(letters, k=rng.randrange(2, 9))) + (rng.choice(signs) if signs and rng.random() < 0.3 else "") + (space or "") for _ in range(70_000))
    assert len(text) > 300_000 and len(text.encode()) > 600_000
    parts = list(Pieces(path).parts(text))
    assert len(parts) > 1 and "".join(parts) == text and max(map(len, parts)) < 1 << 18
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    p = Pieces(path)
    assert p.counts([text]).tolist() == [len(want)]
    ids, sizes = p.encode([text, "x"])
    assert list(ids[: sizes[0]]) == want


def test_cost_balance_of_packing():
    """Whole documents go to the sequence of lowest cost with room: the spread of costs stays under the largest piece's."""
    from tickloom.llm.packing import cost

    rng = random.Random(5)
    sizes = np.array([rng.choice([rng.randrange(1, 60), rng.randrange(100, 400)]) for _ in range(900)])
    total, largest = {}, {}
    for _, _, n, s, _ in pack(sizes, 2000):
        total[s] = total.get(s, 0) + cost(n)
        largest[s] = max(largest.get(s, 0), n)
    assert max(total.values()) - min(total.values()) <= cost(max(largest.values()))


def test_clashing_names_and_ids_that_are_not_numbers(spark):
    df = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id long, text string, n_tokens int, i string")
    assert [tuple(r) for r in token_counts(df, BYTE).collect()] == [(1, 3, 2, False)]
    with pytest.raises(TypeError):
        token_files(spark.createDataFrame([("a", "b")], "doc_id string, text string"), WORD)


def test_words_of_a_group_are_looked_up_once_each_and_equal_the_units_of_every_part():
    class Counting(dict):
        asked = 0

        def __getitem__(self, key):
            Counting.asked += 1
            return super().__getitem__(key)

    p = Pieces(WORD)
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("ab9Éžx.,,. \t\n\r!'é-"), rng.integers(0, 40))) for _ in range(500)] + ["", ".", " ", ". ", "a.", "a.\n", ",a.", "Ā. b", "x..", "A, b."]
    words, counts = p._words(texts)
    units = [p._units(t) for t in texts]
    assert (words.to_pylist(), counts.tolist()) == ([u for x in units for u in x], [len(x) for x in units])
    p.index = Counting(p.index)
    ids, sizes = p.encode(["One word, two words. "] * 3000)
    assert Counting.asked <= 6 and sizes.tolist() == [6] * 3000
    assert ids.tolist() == p.tokenizer.encode("One word, two words. ", add_special_tokens=False).ids * 3000
