"""Exact token ids and counts of a ``tokenizers`` file, with the units of common texts encoded once each.

A text of plain Latin characters is cut at white space, which the tokenizer's own split never crosses; each distinct unit
is encoded once, in a batch, by the library and kept in a bounded table. Any other text goes to the library whole.
"""

from __future__ import annotations

import os
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa

from tickloom.llm.common import byte_chunks, hold

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
#: Units kept per worker; when more are seen the table starts anew.
KEPT_UNITS = 700_000
#: Texts above this many characters are cut at safe boundaries.
LONG = 1 << 17
#: Characters for which Python and the library agree on case, classes and normal form.
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\xac\xae-įı-ňŊ-ž]*")
#: Before white space that follows anything else: no piece of either pattern goes on there. Characters that one library or the
#: other may take for white space don't count as anything else.
_BREAK = re.compile("(?<=[^\\s\x1c-\x1f\x85\u180e\u200b-\u200f\u2028-\u202f\u205f-\u2064\ufeff])(?=[ \t\n\r])")
#: Characters next to which a text is not cut: parts of contractions and of added tokens.
_JOINING = frozenset("'<|>")
#: A sign that ends a word is a piece of its own, so the word is one unit with and without it.
_SIGN = re.compile("(?<=[a-z0-9])([.,])(?=\\s|\\Z)")
#: Runs of white space, and white space that a byte-level split may join with its neighbours.
_RUNS = re.compile(r"\s\s|[\t\r]|^\s|\s\Z")


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level label stands for: printable ones are themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def touching_bytes(vocab) -> np.ndarray:
    """Which bytes stand side by side in some token of a byte-level vocabulary."""
    out, bytes_ = np.zeros((256, 256), bool), byte_of()
    for label in vocab:
        if all(c in bytes_ for c in label):
            data = [bytes_[c] for c in label]
            out[data[:-1], data[1:]] = True
    return out


class Pieces:
    """Token ids by unit, a run of non-space characters with what precedes it, for one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.spaced = self.tokenizer.pre_tokenizer.__class__.__name__ == "ByteLevel"
        if self.spaced:
            self.touching = touching_bytes(self.tokenizer.get_vocab())
        self.joint = "\n" if self.spaced else " \x01 "
        (self.mark,) = self._encode([self.joint])[0]
        self.clear()

    def clear(self) -> None:
        # ``ends`` has the place after each unit's ids in ``flat``; both grow by doubling
        self.index: dict[str, int] = {}
        self.ends = np.zeros(1 << 10, np.int64)
        self.flat = np.zeros(1 << 12, np.uint32)

        #: Pairs of characters that have been asked for, see :meth:`_apart`.
        self.pairs: dict[str, bool] = {}

    def _apart(self, pair: str) -> bool:
        """Whether no token reaches across two characters wherever they stand next to each other.

        Either the library's own split puts them into two pieces, its normaliser leaving each as it is; or, where pieces are
        bytes without an end mark, no token of the vocabulary has the bytes that meet there side by side.
        """
        found = self.pairs.get(pair)
        if found is None:
            if len(self.pairs) > 1 << 20:
                self.pairs.clear()
            x, y = pair
            found = not (x.isspace() or y.isspace() or x in _JOINING or y in _JOINING or unicodedata.combining(x) or unicodedata.combining(y))
            if found and self.spaced:
                found = not self.touching[x.encode("utf-8", "replace")[-1], y.encode("utf-8", "replace")[0]] or len(self.tokenizer.pre_tokenizer.pre_tokenize_str("a" + pair)) - len(self.tokenizer.pre_tokenizer.pre_tokenize_str("a" + x)) == 1
            elif found:
                normal = self.tokenizer.normalizer.normalize_str
                found = normal(pair) == normal(x) + normal(y) and len(self.tokenizer.pre_tokenizer.pre_tokenize_str(normal(pair))) == len(self.tokenizer.pre_tokenizer.pre_tokenize_str(normal(x))) + len(self.tokenizer.pre_tokenizer.pre_tokenize_str(normal(y))) > 1
            self.pairs[pair] = found
        return found

    def parts(self, text: str, limit: int = LONG):
        """Parts of a text of about ``limit`` characters, cut only where no token reaches across, in any script.

        Texts are cut before white space, else between characters that :meth:`_apart` says; what has neither, as a long run of
        letters for a tokenizer with end marks, is one piece for the library too and stays whole.
        """
        lo, at = 0, limit
        while len(text) - lo > limit and at < len(text):
            found = _BREAK.search(text, at, at + limit // 2)
            cut = found.start() if found else None
            if cut is None:
                # a contraction may reach three characters back
                cut = next((i for i in range(at, min(len(text), at + limit // 2)) if self._apart(text[i - 1 : i + 1]) and "'" not in text[max(0, i - 4) : i + 3]), None)
            if cut is None:
                at += limit // 2
                continue
            yield text[lo:cut]
            lo, at = cut, cut + limit
        yield text[lo:]

    def _append(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        known = len(self.index)
        used = int(self.ends[known])
        while len(self.ends) <= known + len(sizes):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        while len(self.flat) < used + len(ids):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[used : used + len(ids)] = ids
        self.ends[known + 1 : known + 1 + len(sizes)] = used + np.cumsum(sizes)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, part: str) -> bool:
        return _PLAIN.fullmatch(part) is not None and "<|" not in part

    def _words(self, parts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """(the units of plain parts as :meth:`_units` has them, for vocabularies that drop white space; units of each part), from the bytes of all at once."""
        raw = np.frombuffer("".join(p + "\0" for p in parts).lower().encode(), np.uint8)
        inner = raw > 0x20
        edges = np.flatnonzero(np.diff(inner, prepend=False))
        starts, ends = edges[::2], edges[1::2]
        # a sign that ends a word, see ``_SIGN``; the byte before a word's first is white space
        last, before = raw[ends - 1], raw[ends - 2]
        signed = ((last == 0x2E) | (last == 0x2C)) & (ends - starts > 1) & (((before >= 0x61) & (before <= 0x7A)) | ((before >= 0x30) & (before <= 0x39)))
        bounds = np.concatenate([[0], np.cumsum(ends - starts)])
        bounds = np.insert(bounds, np.flatnonzero(signed) + 1, bounds[1:][signed] - 1)
        words = np.searchsorted(starts, np.flatnonzero(raw == 0))
        counts = np.diff(words + np.concatenate([[0], np.cumsum(signed)])[words], prepend=0)
        return pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(raw[inner])]), counts

    def _units(self, part: str) -> list[str] | None:
        """The units of a text part, or None if it must go to the library whole."""
        if not self._plain(part):
            return None
        if not self.spaced:
            return _SIGN.sub(r" \1", part.lower()).split()
        if _RUNS.search(part):
            return None
        first, *rest = part.replace("\n", " \n").split(" ")
        return ["\n" + first, *rest]

    def _fresh(self, units: list[str]) -> list[np.ndarray]:
        """Ids of units not seen yet: they are joined by a token of their own, encoded together and cut at that token."""
        texts = ([u[1:] if u[0] == "\n" else " " + u for u in units]) if self.spaced else units
        groups = [self.joint.join(texts[i : i + 512]) + self.joint for i in range(0, len(texts), 512)]
        ids = np.concatenate([np.array(x, np.uint32) for x in self._encode(groups)])
        ends = np.flatnonzero(ids == self.mark)
        if len(ends) != len(units):
            raise ValueError(f"{len(units)} units gave {len(ends)} parts")
        sizes = np.diff(np.concatenate([[-1], ends])) - 1
        return ids[ids != self.mark], sizes

    def _known(self, units: pa.Array) -> np.ndarray:
        """The place of each unit in the table. Arrow finds the distinct ones, so Python looks each up once."""
        coded = units.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [u for u in distinct if u not in self.index]
        if new:
            if len(self.index) + len(new) > KEPT_UNITS and self.index:
                self.clear()
                new = distinct
            ids, sizes = self._fresh(new)
            self._append(ids, sizes)
            base = len(self.index)
            self.index.update(zip(new, range(base, base + len(new)), strict=True))
        return np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy(zero_copy_only=False)]

    def _parts(self, texts: list[str | None]) -> tuple[list[list[str]], list[int], list[tuple[int, str]]]:
        """Units by plain part with the part's text, and the other parts with theirs."""
        plain, owner, other = [], [], []
        for i, text in enumerate(texts):
            if not text:
                continue
            for part in self.parts(text) if len(text) > LONG else (text,):
                if (units := self._units(part)) is None:
                    other.append((i, part))
                else:
                    plain.append(units)
                    owner.append(i)
        return plain, owner, other

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text; a null is empty."""
        plain, owner, other = self._parts(texts)
        out = np.zeros(len(texts), np.int64)
        if plain:
            at = self._known(pa.array(chain.from_iterable(plain), pa.large_string()))
            units = np.fromiter(map(len, plain), np.int64, len(plain))
            sizes = self.ends[at + 1] - self.ends[at]
            if self.spaced:  # a new line is a token; the one before the part's first unit isn't there
                np.add.at(out, owner, [sum(u[:1] == "\n" for u in x) - 1 for x in plain])
            total = np.concatenate([[0], np.cumsum(sizes)])
            ends = np.cumsum(units)
            np.add.at(out, owner, total[ends] - total[ends - units])
        for (i, _), ids in zip(other, self._encode([t for _, t in other]), strict=True):
            out[i] += len(ids)
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, ids of each text); for vocabularies that drop white space, else through the library."""
        out = np.zeros(len(texts), np.int64)
        if self.spaced:
            parts = [(i, p) for i, t in enumerate(texts) for p in self.parts(t or "")]
            ids = self._encode([p for _, p in parts])
            np.add.at(out, [i for i, _ in parts], np.fromiter(map(len, ids), np.int64, len(ids)))
            return np.concatenate([np.zeros(0, np.uint32), *(np.array(x, np.uint32) for x in ids)]), out
        flat, order = [np.zeros(0, np.uint32)], 0
        run: list[str] = []
        owner: list[int] = []

        def close() -> None:
            if run:
                words, counts = self._words(run)
                at = self._known(words)
                sizes = self.ends[at + 1] - self.ends[at]
                total = np.concatenate([[0], np.cumsum(sizes)])
                ends = np.cumsum(counts)
                np.add.at(out, owner, np.diff(total[np.concatenate([[0], ends])]))
                flat.append(self.flat[np.repeat(self.ends[at] - total[:-1], sizes) + np.arange(total[-1])])
                run.clear()
                owner.clear()

        for i, text in enumerate(texts):
            for part in self.parts(text) if text else ():
                if not self._plain(part):
                    close()
                    ids = np.array(self._encode([part])[0], np.uint32)
                    flat.append(ids)
                    out[i] += len(ids)
                else:
                    run.append(part)
                    owner.append(i)
        close()
        return np.concatenate(flat), out


def pieces(path: str) -> Pieces:
    """The worker's table of a tokenizer file."""
    return hold(("tokens", path), lambda: Pieces(path))


def text_groups(batch, name: str = "text", limit: int = 2 << 20):
    """(row range, texts) groups of a batch balanced by bytes."""
    for part in byte_chunks(batch, name, limit):
        yield part, part.column(name).to_pylist()
