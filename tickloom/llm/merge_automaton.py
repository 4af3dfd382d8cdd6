"""BPE by a tokenization automaton: merges compiled by successive merge gadgets, words encoded by its arcs, ids decoded by arc labels.

The automaton reads tokens. It starts with one state that has a loop for every symbol, so it takes every spelling of every
text, symbol by symbol. The gadget of a merge (a, b) takes away the spelling "a, then b" and puts the merged label in its
place: the state behind ``a`` is copied without its arc ``b``, all arcs ``a`` go to the copy, and wherever ``a`` starts an
arc ``ab`` starts as well, to where ``b`` led. After the last merge a text has exactly one path, its tokenization.

A copied state differs from its origin by one arc, so arcs are not copied: a gadget is one entry, (split label, arc taken
away) and rank. The state behind a label has all cuts made there since the label exists, and those that the state of its
right half had before; an arc is there unless one of these cuts took it, or took the left half that it was made of.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import hold, spread
from tickloom.llm.tokens import Pieces, byte_of, text_groups

#: Bits of a label in a key of two.
SHIFT = 20
#: Arcs whose presence is kept once found, and words whose path is; when more are seen the table starts anew.
KEPT_ARCS, KEPT_WORDS = 1 << 20, 1 << 18
#: Symbols of the longest word that is kept.
KEPT_SYMBOLS = 32
_NEVER = 1 << 60


class MergeAutomaton:
    """The automaton of a list of merges over ``vocab`` (label to id); ``suffix`` marks the labels that end a word."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        if len(vocab) >= 1 << SHIFT:
            raise ValueError(f"more than {1 << SHIFT} labels")
        self.suffix = suffix
        size = max(vocab.values(), default=-1) + 1
        self.born, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        #: (split label, arc taken away) to the rank of the gadget.
        self.cuts: dict[int, int] = {}
        self._arcs: dict[int, bool] = {}
        self._paths: dict[str, list[int]] = {}
        made = {a + b for a, b in merges}
        alive = {i for label, i in vocab.items() if label not in made}
        for rank, (a, b) in enumerate(merges):
            first, second, whole = vocab[a], vocab[b], vocab[a + b]
            if self.left[whole] >= 0 or max(self.born[first], self.born[second]) >= rank or (a in made and self.left[first] < 0) or (b in made and self.left[second] < 0):
                raise ValueError(f"merge {rank} makes a label twice or of labels not made yet")
            self.born[whole], self.left[whole], self.right[whole] = rank, first, second
            if first in alive and second in alive and self._has_arc(first, second):
                alive.add(whole)
                self.cuts[first << SHIFT | second] = rank
        # all live labels by their symbols, as a table of steps; a label ends inside a word or, with the suffix, at its end
        self.steps: list[dict[str, int]] = [{}]
        self.inside: list[int] = [-1]
        self.final: list[int] = [-1]
        self.size, self.shorter = [0] * size, [-1] * size
        self.longest = 0
        spelled = {}
        for label, i in vocab.items():
            if i in alive:
                last = bool(suffix) and label.endswith(suffix)
                text = label[: -len(suffix)] if last else label
                spelled[i] = text
                self.size[i] = len(text)
                self.longest = max(self.longest, len(text))
                node = 0
                for c in text:
                    if c not in self.steps[node]:
                        self.steps[node][c] = len(self.steps)
                        self.steps.append({})
                        self.inside.append(-1)
                        self.final.append(-1)
                    node = self.steps[node][c]
                if last or not suffix:
                    self.final[node] = i
                if not last:
                    self.inside[node] = i
        none: dict[str, int] = {}
        self.steps = [x or none for x in self.steps]
        for i, text in spelled.items():
            node = 0
            for c in text[:-1]:
                node = self.steps[node][c]
                if self.inside[node] >= 0:
                    self.shorter[i] = self.inside[node]

    def _has_arc(self, label: int, arc: int) -> bool:
        """Whether the state behind ``label`` has ``arc``."""
        split, before = label, _NEVER
        while split >= 0:
            part, until = arc, _NEVER
            while part >= 0:
                rank = self.cuts.get(split << SHIFT | part)
                if rank is not None and rank < before and rank <= until:
                    return False
                part, until = self.left[part], self.born[part]
            split, before = self.right[split], self.born[split]
        return True

    def has_arc(self, label: int, arc: int) -> bool:
        key = label << SHIFT | arc
        found = self._arcs.get(key)
        if found is None:
            if len(self._arcs) >= KEPT_ARCS:
                self._arcs.clear()
            found = self._arcs[key] = self._has_arc(label, arc)
        return found

    def path(self, word: str) -> list[int]:
        """:meth:`encode` with the paths of short words kept."""
        found = self._paths.get(word)
        if found is None:
            found = self.encode(word)
            if len(word) <= KEPT_SYMBOLS:
                if len(self._paths) >= KEPT_WORDS:
                    self._paths.clear()
                self._paths[word] = found
        return found

    def encode(self, word: str) -> list[int]:
        """The labels on the path of a word. Time and memory grow with its length.

        At each place the longest label that has an arc is tried first; a place is left for good when none leads on, since only
        one path reaches it.
        """
        steps, inside, size, shorter, known, has_arc = self.steps, self.inside, self.size, self.shorter, self._arcs, self.has_arc
        n, at = len(word), 0
        path: list[int] = []
        dead: set[int] = set()
        while at < n:
            node, label, end = 0, -1, at
            for c in word[at : at + self.longest]:
                step = steps[node].get(c)
                if step is None:
                    break
                node = step
                end += 1
                if inside[node] >= 0 and end < n:
                    label = inside[node]
            if end == n and self.final[node] >= 0:
                label = self.final[node]
            while True:
                while label >= 0 and ((dead and at + size[label] in dead) or (path and not (known.get(path[-1] << SHIFT | label) or has_arc(path[-1], label)))):
                    label = shorter[label]
                if label >= 0:
                    break
                if not path:
                    raise ValueError(f"no label reads {word[:20]!r}")
                dead.add(at)
                label = path.pop()
                at -= size[label]
                label = shorter[label]
            path.append(label)
            at += size[label]
        return path


class AutomatonPieces(Pieces):
    """Ids of texts as :class:`Pieces` has them, with words encoded by the automaton; the library only normalises and splits texts into words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError(f"{path}: only plain BPE is compiled")
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens must be plain strings")
        self.automaton = MergeAutomaton({k: v for k, v in model["vocab"].items() if k not in added}, merges, model.get("end_of_word_suffix") or "")
        self.added = added
        super().__init__(path)

    def _runs(self, text: str) -> list[str]:
        """Texts between added tokens, and these, in turns; of tokens that start at one place the longest counts."""
        import re

        return re.split("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")", text) if self.added else [text]

    def _split(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        if self.tokenizer.normalizer is not None:
            text = self.tokenizer.normalizer.normalize_str(text)
        return self.tokenizer.pre_tokenizer.pre_tokenize_str(text)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        out = []
        for text in texts:
            ids: list[int] = []
            for n, run in enumerate(self._runs(text)):
                if n % 2:
                    ids.append(self.added[run])
                elif run:
                    for word, _ in self._split(run):
                        ids += self.automaton.path(word)
            out.append(ids)
        return out

    def _fresh(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.spaced:
            return super()._fresh(units)
        ids: list[int] = []
        sizes = np.zeros(len(units), np.int64)
        for lo in range(0, len(units), 512):
            some = units[lo : lo + 512]
            ends = np.cumsum(np.fromiter(map(len, some), np.int64, len(some)) + 1)
            words = self.tokenizer.pre_tokenizer.pre_tokenize_str(" ".join(some))
            owner = np.searchsorted(ends, np.fromiter((a for _, (a, _) in words), np.int64, len(words)), "right") + lo
            counts = np.zeros(len(words), np.int64)
            for k, (word, _) in enumerate(words):
                found = self.automaton.path(word)
                ids += found
                counts[k] = len(found)
            np.add.at(sizes, owner, counts)
        return np.array(ids, np.uint32), sizes


def _table(path: str) -> AutomatonPieces:
    return hold(("automaton", path), lambda: AutomatonPieces(path))


def bpe_encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of each row's whole text, by the automaton of the tokenizer's merges.

    ``tokenizer`` is a file of the tokenizers library with a plain BPE model; its normaliser, its split into words and its
    added tokens are kept, begin and end tokens are not put in. Map only over the splits of the input (a small input of few
    splits is dealt over the cores): hot sources, ties and repeated rows change nothing, every row gives one, an empty table
    none. A null or empty text has no ids, a null id stays null. Long texts are cut where no token can cross, a long word is
    walked in one go. Other columns are ignored, so their names can't clash.
    """
    source = spread(docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")))
    id_type = source.schema["i"].dataType.simpleString()

    def run(batches):
        table = _table(tokenizer)
        for batch in batches:
            for part, texts in text_groups(batch, "t"):
                ids, sizes = table.encode(texts)
                ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column("i"), pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int32)))], ["doc_id", "ids"])

    return source.mapInArrow(run, f"doc_id {id_type}, ids array<int>")


def labels_of(tokenizer: str) -> tuple[pa.Array, bool]:
    """(labels by id, whether they are bytes to be put together); a gap in the ids is a null."""
    with open(tokenizer, encoding="utf-8") as f:
        spec = json.load(f)
    kind = (spec.get("decoder") or {"type": None})["type"]
    if kind not in (None, "ByteLevel"):
        raise ValueError(f"decoder {kind} is not known")
    vocab = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    labels: list[str | None] = [None] * (max(vocab.values(), default=-1) + 1)
    for label, i in vocab.items():
        labels[i] = label
    return pa.array(labels, pa.string()), kind == "ByteLevel"


def bpe_decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, text): each row's ids and the text that the labels of its arcs spell.

    Labels are joined by one space where the file names no decoder, and put together as bytes, with the replacement
    character for what is no UTF-8, where it names a byte-level one; added tokens are labels like others. Ids without a
    label are left out. Null or no ids give an empty text. Map only; repeated rows stay, an empty table stays empty.
    """
    source = encoded.select(F.col(id_col).alias("i"), F.col(ids_col).alias("x"))
    id_type = source.schema["i"].dataType.simpleString()

    def run(batches):
        labels, in_bytes = hold(("labels", tokenizer), lambda: labels_of(tokenizer))
        bytes_ = byte_of() if in_bytes else {}
        space = b"" if in_bytes else b" "
        data = pa.array([None if x is None else bytes(bytes_[c] for c in x) if all(c in bytes_ for c in x) else x.encode() for x in labels.to_pylist()], pa.binary()) if in_bytes else labels.cast(pa.binary())
        for whole in batches:
            ids = whole.column("x")
            sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
            lo = 0
            while lo < len(whole):  # parts of about a million ids, a row at least
                hi = max(lo + 1, int(np.searchsorted(np.cumsum(sizes[lo:]), 1 << 20, "right")) + lo)
                batch = whole.slice(lo, hi - lo)
                lo = hi
                lists = pc.fill_null(batch.column("x"), pa.scalar([], batch.column("x").type))
                flat = lists.flatten()
                known = pc.take(data, pc.if_else(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(data))), flat, None))
                ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
                if known.null_count:
                    held = known.is_valid().to_numpy(zero_copy_only=False)
                    ends = np.concatenate([[0], np.cumsum(held)])[ends]
                    known = known.drop_null()
                spelled = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), known), pa.scalar(space, pa.binary()))
                texts = pa.array([x.decode("utf-8", "replace") for x in spelled.to_pylist()], pa.string()) if in_bytes else spelled.cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("i"), batch.column("x"), texts], ["doc_id", "ids", "text"])

    return source.mapInArrow(run, f"doc_id {id_type}, ids array<int>, text string")
