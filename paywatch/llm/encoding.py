"""Exact token ids from a public tokenizer file, with repeated words encoded once per worker."""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from functools import cache

import numpy as np
import pyarrow as pa

# Words a worker remembers per generation; two generations are kept, so what is in use stays.
MEMO_WORDS = 300_000
# Unknown pieces are encoded this many at a time, as one text with separators whose id shows where each piece ends.
JOINED = 512
GROUP_BYTES = 1 << 22
GAP = re.compile(r"(?<=\S)(?= \S)")
# White space other than lone blanks and line ends, as UTF-8, the wide ones by their first byte (U+2000 to U+203F by their common bytes).
LINE_GAPS = (b"  ", b" \n", b"\n ", b"\n\n")
WIDE_GAPS = {b"\xc2": (b"\xc2\x85", b"\xc2\xa0"), b"\xe1": (b"\xe1\x9a\x80",), b"\xe2": (b"\xe2\x80", b"\xe2\x81\x9f"), b"\xe3": (b"\xe3\x80\x80",)}
OTHER_SPACE = bytes([*range(0x09, 0x0A), *range(0x0B, 0x0E), *range(0x1C, 0x20)])
LAST_LATIN = "\u024f"
# What a word may end in that has ids of its own: a run of these. Apostrophes may belong to the word, the joined pieces' marks do not.
ENDS = b"!#$%&()*+,-./:;<=>?@[]^_`{}~"
# The kind of every byte: 1 a blank or line end, 2 a letter or digit, 4 one of ENDS.
KINDS = np.array([1 if b in b" \n" else 2 if chr(b).isalnum() and b < 128 else 4 if b in ENDS else 0 for b in range(256)], np.uint8)


def _byte_letters() -> str:
    """The letters that byte-level vocabularies write bytes with: printable ones are themselves, others follow from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return "".join(chr(b) if b in own else chr(next(others)) for b in range(256))


BYTE_LETTERS = _byte_letters()


def _whole(text: bytes) -> list[bytes]:
    return [text] if text else []


def _blank_separated(text: bytes) -> list[bytes]:
    """For tokenizers that drop white space and fold case: words are independent of each other."""
    return text.lower().split()


def _even(text: bytes) -> bool:
    """No white space but lone blanks and line ends between other characters."""
    if text.strip() != text or any(g in text for g in LINE_GAPS) or len(text.translate(None, OTHER_SPACE)) < len(text):
        return False
    return text.isascii() or not any(lead in text and any(g in text for g in gaps) for lead, gaps in WIDE_GAPS.items())


def _blank_led(text: bytes) -> list[bytes]:
    """For byte-level BPE, whose pieces never run past a lone blank or line end between other characters."""
    if not _even(text):
        return [p.encode() for p in GAP.split(text.decode()) if p]
    return text.replace(b"\n", b" \n ").replace(b" ", b"\t ").replace(b"\t \n\t ", b"\t\n\t").split(b"\t") if text else []


def _numbered(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct pieces of even texts, the number of every piece in reading order, and how many there are up to each text's end.

    A piece also ends where one of ENDS follows a letter or digit: there a byte-level tokenizer cuts whatever stands around.
    """
    joined = b"".join(texts)
    stop = np.cumsum([len(t) for t in texts])
    read = np.frombuffer(joined, np.uint8)
    kind = KINDS[read]
    line = read == 10
    first = np.ones(len(read) + 1, bool)
    first[:-1] = kind == 1
    first[1:] |= line
    first[1:-1] |= kind[:-1] + kind[1:] * 4 == 18
    first[0] = first[stop] = True
    begin = np.flatnonzero(first).astype(np.int32)
    pieces = pa.Array.from_buffers(pa.binary(), len(begin) - 1, [None, pa.py_buffer(begin), pa.py_buffer(joined)]).dictionary_encode()
    _, at, held = pieces.dictionary.buffers()
    at, held = np.frombuffer(at, np.int32)[: len(pieces.dictionary) + 1].tolist(), held.to_pybytes()
    return [held[a:b] for a, b in zip(at, at[1:])], pieces.indices.to_numpy(), np.searchsorted(begin, stop)


def _splitter(spec: dict):
    """How to cut a text into pieces whose ids, joined, are the ids of the text, and what may stand between pieces
    without changing their ids. A tokenizer of unknown kind gets whole texts."""
    before, normal = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and normal is None:
        return _blank_led, "\n", "\n"
    steps = (normal or {}).get("normalizers", [])
    folds = [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": r"\s+"}
    cuts = (before.get("pretokenizers") or [{}])[0]
    if folds and cuts.get("type") == "Split" and cuts.get("behavior") == "Removed" and r"[^\s" in cuts["pattern"].get("Regex", ""):
        return _blank_separated, "|", " | "
    return _whole, "", ""


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers; special tokens' strings are ordinary text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            self._split, self._mark, self._between = _splitter(json.load(file))
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._model = self._tokenizer.model
        self.size = self._tokenizer.get_vocab_size(with_added_tokens=True)
        self._folds = self._tokenizer.normalizer is not None
        marks = self._ids([self._mark])[0] if self._mark else ()
        self._mark_id = int(marks[0]) if len(marks) == 1 else None
        self._now: dict[bytes, bytes] = {}
        self._before: dict[bytes, bytes] = {}

    def _ids(self, strings: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self._tokenizer.encode_batch_fast(strings, add_special_tokens=False)]

    def _is_word(self, piece: bytes) -> bool:
        """One run of Latin letters, with a blank before it where the tokenizer keeps blanks, that nothing rewrites."""
        word = piece[1:] if piece[:1] == b" " else piece
        if word.isascii():
            return word.isalpha()
        string = word.decode()
        return string.isalpha() and max(string) <= LAST_LATIN and (not self._folds or (string.lower() == string and unicodedata.is_normalized("NFC", string)))

    def _encode_words(self, words: list[bytes]) -> None:
        """Plain words, by the model itself. Latin letters other than ASCII are written byte by byte, ASCII ones as they are."""
        joined = b"\n".join(words)
        if joined.isascii():
            lettered = joined.decode().replace(" ", BYTE_LETTERS[32]).split("\n")
        else:
            lettered = joined.decode("latin-1").translate(BYTE_LETTERS).split(BYTE_LETTERS[10])
        tokenize = self._model.tokenize
        self._now.update(zip(words, [array("I", [t.id for t in tokenize(x)]).tobytes() for x in lettered]))

    def _encode_others(self, pieces: list[bytes]) -> None:
        """Other pieces, many as one text, with marks between."""
        mark, now = self._mark.encode(), self._now
        alone = [p for p in pieces if mark in p] if self._mark_id is not None else pieces
        joined = [p for p in pieces if mark not in p] if self._mark_id is not None else []
        groups = [joined[at : at + JOINED] for at in range(0, len(joined), JOINED)]
        between = self._between.encode()
        for group, ids in zip(groups, self._ids([between.join(g).decode() for g in groups])):
            parts = np.flatnonzero(ids == self._mark_id)
            if len(parts) != len(group) - 1:
                alone = alone + group
                continue
            data, ends = ids.tobytes(), (4 * parts).tolist()
            now.update(zip(group, [data[b:e] for b, e in zip([0, *[x + 4 for x in ends]], [*ends, len(data)])]))
        if alone:
            now.update(zip(alone, [ids.tobytes() for ids in self._ids([p.decode() for p in alone])]))

    def _recalled(self, pieces: list[bytes]) -> list[bytes]:
        """Bring over what the generation before remembers; the rest is given back."""
        if not self._before:
            return pieces
        held = list(map(self._before.get, pieces))
        self._now.update([(p, ids) for p, ids in zip(pieces, held) if ids is not None])
        return [p for p, ids in zip(pieces, held) if ids is None]

    def _fill(self, pieces: list[bytes]) -> None:
        """Remember the ids of distinct pieces; what ends one after a letter or digit, see ENDS, has ids of its own."""
        now, new = self._now, self._recalled(pieces)
        if self._mark_id is None:
            self._encode_others(new)
            return
        plain = [p[1:].isalpha() and (p[0] == 32 or p[:1].isalpha()) for p in new]
        words = [p for p, is_plain in zip(new, plain) if is_plain]
        rest = [(p, p.rstrip(ENDS)) for p, is_plain in zip(new, plain) if not is_plain]
        cut = [len(stem) < len(p) and (stem[-1:].isalnum() or self._is_word(stem)) for p, stem in rest]
        ended = [(p, stem, p[len(stem) :]) for (p, stem), c in zip(rest, cut) if c]
        parts = {x for _, *both in ended for x in both}.difference(words)
        parts = self._recalled([p for p in parts if p not in now])
        others = dict.fromkeys([p for (p, _), c in zip(rest, cut) if not c] + parts)
        apart = [p for p in others if self._is_word(p)]
        self._encode_words(words)
        self._encode_words(apart)
        self._encode_others(list(others.keys() - apart))
        now.update([(p, now[stem] + now[end]) for p, stem, end in ended])

    def _encode_even(self, texts: list[bytes]) -> list[bytes]:
        """Even texts: distinct pieces are looked up, the ids of all follow by their numbers."""
        if not any(texts):
            return list(texts)
        pieces, numbers, last = _numbered(texts)
        ids = list(map(self._now.get, pieces))
        gaps = [i for i, x in enumerate(ids) if x is None] if None in ids else []
        self._fill([pieces[i] for i in gaps])
        for i in gaps:
            ids[i] = self._now[pieces[i]]
        size = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        shift = np.cumsum(size, dtype=np.int32) - size
        size, shift = size[numbers], shift[numbers]
        stop = np.cumsum(size, dtype=np.int32)
        place = np.repeat(shift - stop + size, size)
        place += np.arange(len(place), dtype=np.int32)
        data = np.frombuffer(b"".join(ids), "<u4")[place].tobytes()
        cuts = (4 * np.concatenate([[0], stop])[last].astype(np.int64)).tolist()
        return [data[a:b] for a, b in zip([0, *cuts], cuts)]

    def _encode_pieces(self, pieces: list[list[bytes]]) -> list[bytes]:
        known = self._now.get
        found = [list(map(known, p)) for p in pieces]
        gaps = [[i for i, x in enumerate(f) if x is None] if None in f else () for f in found]
        self._fill(list({p[i] for p, g in zip(pieces, gaps) for i in g}))
        for p, f, g in zip(pieces, found, gaps):
            for i in g:
                f[i] = known(p[i])
        return list(map(b"".join, found))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= GROUP_BYTES):
                size += len(texts[stop])
                stop += 1
            if len(self._now) > MEMO_WORDS:
                self._before, self._now = self._now, {}
            group = texts[at:stop]
            even = [self._split is _blank_led and _even(t) for t in group]
            numbered = iter(self._encode_even([t for t, e in zip(group, even) if e]))
            others = iter(self._encode_pieces([self._split(t) for t, e in zip(group, even) if not e]))
            out.extend(next(numbered if e else others) for e in even)
            at = stop
        return out


@cache
def encoder(path: str) -> Encoder:
    """One encoder per file and worker process."""
    return Encoder(path)
