import hashlib
import random
from itertools import product

import pytest
from tokenizers import Tokenizer

from tickloom.llm.merge_automaton import AutomatonPieces, MergeAutomaton, bpe_decode, bpe_encode
from tickloom.llm.queries import QUERIES

public = pytest.importorskip("public_tokenizers")
NAMES = ("word_bpe_49k.json", "byte_bpe_50k.json")


def _gadgets(symbols, merges):
    """The automaton with every arc written out: {state: {label: state}}, state 0 first."""
    arcs = {0: dict.fromkeys(symbols, 0)}
    for a, b in merges:
        for q in {to[a] for to in arcs.values() if a in to}:
            if b not in arcs[q]:
                continue
            copy, after = max(arcs) + 1, arcs[q][b]
            arcs[copy] = {x: to for x, to in arcs[q].items() if x != b}
            for out in arcs.values():
                if out.get(a) == q:
                    out[a], out[a + b] = copy, after
    return arcs


def _bpe(word, merges):
    """Merges in order, each over the whole word from the left."""
    parts = list(word)
    for a, b in merges:
        out, i = [], 0
        while i < len(parts):
            if parts[i : i + 2] == [a, b]:
                out.append(a + b)
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out
    return parts


@pytest.mark.parametrize("seed", range(12))
def test_cuts_are_the_gadgets_written_out(seed):
    rnd = random.Random(seed)
    labels, merges = list("abc"), []
    while len(merges) < 9:
        a, b = rnd.choice(labels), rnd.choice(labels)
        if a + b not in labels:
            merges.append((a, b))
            labels.append(a + b)
    vocab = {x: i for i, x in enumerate(labels)}
    machine, arcs = MergeAutomaton(vocab, merges), _gadgets("abc", merges)
    behind = {}
    for out in arcs.values():
        for label, to in out.items():
            behind[label] = to
    reached, todo = {0}, [0]
    while todo:
        for to in arcs[todo.pop()].values():
            if to not in reached:
                reached.add(to)
                todo.append(to)
    live = {x for q in reached for x in arcs[q]}
    for a in live:
        assert {x for x in live if machine.has_arc(vocab[a], vocab[x])} == set(arcs[behind[a]]), (a, merges)
    for n in range(1, 8):
        for word in map("".join, product("abc", repeat=n)):
            assert [labels[i] for i in machine.encode(word)] == _bpe(word, merges)


def test_merges_that_are_not_in_order_are_refused():
    with pytest.raises(ValueError, match="merge 0"):
        MergeAutomaton({"a": 0, "b": 1, "ab": 2, "abb": 3}, [("ab", "b"), ("a", "b")])


def _texts():
    rnd = random.Random(5)
    pieces = ["the", "Thing", "don't", "we'LL", "12", " ", "\n", "\t\t", "é", "É", "é", "ﬁ", "İ", "中文字", "ภาษาไทย", "हिन्दी", "😀👍🏽", "<|endoftext|>", "<|startoftext|>", "<|end", "\x00", "‍", "ß", "Ω", "_", "--", "…"]
    made = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 60))) for _ in range(400)]
    long = ["x" * 300_000, "ab " * 200_000, "中" * 150_000, "😀" * 40_000, "1" * 200_000, "Ab1'd é\n" * 60_000]
    return [None, "", " ", "\n\n", *made, *long, made[0], made[0]]


@pytest.mark.parametrize("name", NAMES)
def test_equals_the_library(spark, name):
    path = public.path(name)
    library, texts = Tokenizer.from_file(path), _texts()
    docs = spark.createDataFrame([(i if i != 7 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in bpe_decode(bpe_encode(docs, path), path).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        row = got[i if i != 7 else None]
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert row.ids == ids, repr((text or "")[:80])
        assert row.text == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("name", NAMES)
def test_plain_and_other_texts_in_one_group(name):
    """Plain texts take their words from the bytes of a group, others are normalised and split one by one."""
    path, texts = public.path(name), ["The words, and the signs.", None, "", "plain é again the words,", "日本語 and <|endoftext|> there", "x", "The last. "]
    library = Tokenizer.from_file(path)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    ids, sizes = AutomatonPieces(path).encode(texts)
    assert sizes.tolist() == list(map(len, want)) and ids.tolist() == [i for x in want for i in x]


def test_decode_of_odd_rows(spark):
    path = public.path("word_bpe_49k.json")
    rows = spark.createDataFrame([(1, None), (2, []), (3, [320, None, 10**6, -5, 49407])], "doc_id long, ids array<int>")
    label = Tokenizer.from_file(path).id_to_token(320)
    assert {r.doc_id: r.text for r in bpe_decode(rows, path).collect()} == {1: "", 2: "", 3: f"{label} <|endoftext|>"}
    assert bpe_encode(spark.createDataFrame([], "doc_id long, text string"), path).collect() == []


def test_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in QUERIES["op11_bpe"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        row, sha = got[d.doc_id], lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
