"""Quality rules, line first: failing lines go, then documents that lose too much of their text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import LOWER, NON_SPACE, SEGMENT, byte_chunks, mix, span_totals, spread, text_bytes, word_hashes, word_spans
from tickloom.llm.decontaminate import gram_hashes

#: Fixed values of the base counts.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, RUN, REPEAT_PERCENT = 10, 5, 20
#: Line rules. A line fails if it has this many separators (navigation), doubled exclamation marks, this percentage of
#: symbol characters, this many words without any sentence punctuation, or a boilerplate phrase.
BARS, SHOUTS, SYMBOL_PERCENT, BARE_WORDS = 2, 3, 20, 4
SEPARATORS = "|›→•"
#: Phrases of licences, notices, consent banners and page furniture in some languages; only A-Z is compared in lower case, so
#: those in Cyrillic leave out the first letter.
BOILERPLATE = (
    "licensed under|copyright|all rights reserved|spdx-license-identifier|terms of use|privacy policy|cookie policy|click here|permission is hereby granted"
    "|lorem ipsum|enable javascript|skip to content|tous droits réservés|politique de confidentialité|mentions légales|alle rechte vorbehalten|datenschutzerklärung"
    "|todos los derechos reservados|política de privacidad|todos os direitos reservados|tutti i diritti riservati|се права защищены|олитика конфиденциальности"
    "|جميع الحقوق محفوظة|سياسة الخصوصية|版权所有|隐私政策|無断転載を禁じます|プライバシーポリシー"
)
#: Sentence punctuation of the scripts that have some.
PUNCTUATION = ".!?,;:…؟،؛۔।॥。、！？；：，．።፣၊။·՝։"
#: Scripts that end a sentence by a space, so that their lines need no punctuation: Thai, Lao, Tibetan, Myanmar, Khmer.
UNPUNCTUATED = (("\u0e00", "\u0fff"), ("\u1000", "\u109f"), ("\u1780", "\u17ff"))
#: A document goes if over this percentage of its lines' words, in characters, is removed.
LOST_PERCENT = 50
_PHRASES = [x.encode() for x in BOILERPLATE.split("|")]


def _table(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars.encode())] = True
    return table


def _points(chars: str) -> np.ndarray:
    """A table of the code points below 65,536."""
    table = np.zeros(1 << 16, bool)
    table[[ord(c) for c in chars]] = True
    return table


_SYMBOL, _BANG = _table(SYMBOLS), _table("!")
_BAR, _STOP = _points(SEPARATORS), _points(PUNCTUATION)
#: A line with one of these is not bare.
_FREE = _STOP.copy()
for _a, _b in UNPUNCTUATED:
    _FREE[ord(_a) : ord(_b) + 1] = True
#: Bytes that begin a character other than white space.
_CHARACTER = NON_SPACE & ((np.arange(256) & 0xC0) != 0x80)


def marked(data: np.ndarray, points: np.ndarray):
    """A function of a segment's bounds: which of its bytes begin a character of ``points``."""

    def flags(lo: int, hi: int) -> np.ndarray:
        part = data[lo : min(len(data), hi + 2)]
        out = points[part[: hi - lo].astype(np.uint16)]
        out[part[: hi - lo] >= 0x80] = False
        at = np.flatnonzero((part[: hi - lo] >= 0xC2) & (part[: hi - lo] < 0xF0))
        if len(at):
            lead, second = part[at].astype(np.int64), part[np.minimum(at + 1, len(part) - 1)].astype(np.int64) & 0x3F
            third = part[np.minimum(at + 2, len(part) - 1)].astype(np.int64) & 0x3F
            out[at] = points[np.where(lead < 0xE0, (lead & 0x1F) << 6 | second, (lead & 0x0F) << 12 | second << 6 | third)]
        return out

    return flags


def _distinct(row: np.ndarray, hashes: np.ndarray, rows: int) -> np.ndarray:
    """Distinct hashes of each row."""
    order = np.lexsort((hashes, row))
    r, h = row[order], hashes[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    return np.bincount(r[new], minlength=rows)


def _repeated(words: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Words of each row inside ``RUN``-word windows that occur twice or more in the row."""
    rows, n = len(before) - 1, len(words)
    row = np.repeat(np.arange(rows), np.diff(before))
    at = np.flatnonzero(np.repeat(before[1:], np.diff(before)) - np.arange(n) >= RUN)
    if not len(at):
        return np.zeros(rows, np.int64)
    key = mix(gram_hashes(words, RUN)[at] + row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    starts = at[order[twice]]
    cover = np.bincount(starts, minlength=n + 1) - np.bincount(starts + RUN, minlength=n + 1)[: n + 1]
    return np.bincount(row[np.cumsum(cover)[:n] > 0], minlength=rows)


def line_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of the lines of each row; a row has one line more than line feeds."""
    feeds = np.flatnonzero(data == 10)
    row = np.searchsorted(off, feeds, "right") - 1
    starts = np.concatenate([off[:-1], feeds + 1])
    ends = np.concatenate([feeds, off[1:]])
    order = np.lexsort((starts, np.concatenate([np.arange(len(off) - 1), row])))
    rows = np.sort(np.concatenate([np.arange(len(off) - 1), row]), kind="stable")
    closing = np.lexsort((ends, np.concatenate([row, np.arange(len(off) - 1)])))
    return starts[order], ends[closing], rows


def failing_lines(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, chars: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Whether each line, of ``chars`` characters besides white space and so many ``words``, is removed."""
    fails = span_totals(marked(data, _BAR), data, starts, ends) >= BARS
    bangs = span_totals(_BANG, data, starts, ends)
    for line in np.flatnonzero(bangs >= 2 * SHOUTS).tolist():
        # pairs of exclamation marks, none counted twice
        fails[line] |= data[starts[line] : ends[line]].tobytes().count(b"!!") >= SHOUTS
    fails |= 100 * span_totals(_SYMBOL, data, starts, ends) > SYMBOL_PERCENT * chars
    fails |= (words >= BARE_WORDS) & (span_totals(marked(data, _FREE), data, starts, ends) == 0)
    most = max(map(len, _PHRASES))
    for lo in range(0, len(data), SEGMENT):
        low = LOWER[data[lo : lo + SEGMENT + most]].tobytes()
        for phrase in _PHRASES:
            at = low.find(phrase)
            while at >= 0:
                line = int(np.searchsorted(starts, lo + at, "right")) - 1
                if lo + at + len(phrase) <= ends[line]:
                    fails[line] = True
                at = low.find(phrase, at + 1)
    return fails


def measure_all(data: np.ndarray, off: np.ndarray):
    """(columns of counts and flags by row; lines' starts, ends, rows and whether they stay) of texts as bytes."""
    rows = len(off) - 1
    starts, ends, before = word_spans(data, off, NON_SPACE)
    n_words = np.diff(before)
    repeated = _repeated(word_hashes(data, starts, ends), before)
    word_chars, symbols = span_totals(_CHARACTER, data, off[:-1], off[1:]), span_totals(_SYMBOL, data, off[:-1], off[1:])
    a, b, row = line_spans(data, off)
    chars = span_totals(_CHARACTER, data, a, b)
    words = np.searchsorted(starts, b) - np.searchsorted(starts, a)
    full = chars > 0
    fails = np.zeros(len(a), bool)
    fails[full] = failing_lines(data, a, b, chars, words)[full]
    lines = np.flatnonzero(full)
    dup = np.bincount(row[lines], minlength=rows) - _distinct(row[lines], word_hashes(data, a[lines], b[lines]), rows)
    lost, total = np.bincount(row, chars * fails, rows).astype(np.int64), np.bincount(row, chars, rows).astype(np.int64)
    failed = (n_words < LEAST_WORDS) | (100 * repeated > REPEAT_PERCENT * n_words)
    kept = ~failed & (100 * lost <= LOST_PERCENT * total)
    return (n_words, word_chars, symbols, dup, repeated, failed, kept), (a, b, row, ~fails)


def _cleaned(data: np.ndarray, lines, rows: int) -> list[str]:
    """Each text without its failing lines."""
    out: list[list[bytes]] = [[] for _ in range(rows)]
    raw = data.tobytes()
    for a, b, row, stays in zip(*(x.tolist() for x in lines), strict=True):
        if stays:
            out[row].append(raw[a:b])
    return [b"\n".join(x).decode() for x in out]


def measure(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, cleaned text) of one text."""
    data, off = text_bytes(pa.array([text], pa.string()))
    columns, lines = measure_all(data, off)
    return (*(x[0].item() for x in columns), _cleaned(data, lines, 1)[0])


def repeated_words(words: list[str]) -> int:
    """Words inside ``RUN``-word windows that occur twice or more."""
    return measure(" ".join(words))[4]


def line_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept (and the cleaned text).

    Map only, one row per input row, none for an empty table. A null or empty text has no words and fails; a long text is
    measured whole, in segments; null ids and repeated rows are kept as they are; other columns are ignored.
    """

    def run(batches):
        for whole in batches:
            for batch in byte_chunks(whole, "t", 2 << 20):
                data, off = text_bytes(batch.column("t"))
                columns, lines = measure_all(data, off)
                fields = [pa.array(x, pa.int64()) for x in columns[:5]] + [pa.array(x) for x in columns[5:]]
                yield pa.RecordBatch.from_arrays([batch.column("i"), *fields, *([pa.array(_cleaned(data, lines, len(batch)), pa.string())] if with_text else [])], names)

    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *(["text"] if with_text else [])]
    source = spread(docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")))
    kinds = [source.schema["i"].dataType.simpleString(), *["long"] * 5, "boolean", "boolean", "string"]
    return source.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=False)))
