"""SentencePiece encoding by merges, with a score-ordered agenda, checked against the library batch by batch."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cache, partial
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from paywatch.llm.common import texts

SPACE = "▁"
# Words a worker remembers per generation; two generations are kept, so what is in use stays.
MEMO_WORDS = 200_000
# Texts are worked on in groups of about this many characters, a longer one alone.
GROUP_CHARS = 1 << 20
SHORT_WORD = 32
NO_PIECE = float("inf")
ENCODED = "doc_id long, ids binary, decoded string, agrees boolean"


def _word_pattern(pieces: list[str]) -> str:
    """A pattern for parts of a text that no merge reaches out of.

    Characters that stand side by side in some piece belong together, whatever else they are next to in a text; a
    piece may start with blanks, and none but a run of blanks goes on past one. A vocabulary with pieces across blanks
    gets whole texts.
    """
    if any(SPACE in p.lstrip(SPACE) for p in pieces):
        return "(?s).+"
    root: dict[str, str] = {}

    def find(c: str) -> str:
        while root.setdefault(c, c) != c:
            root[c] = c = root[root[c]]
        return c

    for piece in pieces:
        body = piece.lstrip(SPACE)
        if len(piece) > 1 and body:
            find(body[0])
            for left, right in zip(body, body[1:]):
                root[find(left)] = find(right)
    kinds: dict[str, list[str]] = {}
    for c in root:
        kinds.setdefault(find(c), []).append(c)
    runs = [f"{SPACE}*[{''.join(map(re.escape, sorted(k)))}]+" for k in sorted(kinds.values(), key=len, reverse=True)]
    return "(?s)" + "|".join([*runs, f"{SPACE}+", "."])


class MergeEncoder:
    """Ids of a merge-type model: symbols start as characters, the best-scored adjacent pair merges until none is left."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = library = SentencePieceProcessor(model_file=path)
        special = (library.is_control, library.is_unknown, library.is_byte, library.is_unused)
        plain = [i for i in range(library.get_piece_size()) if not any(test(i) for test in special)]
        self._ids = {library.id_to_piece(i): i for i in plain}
        self._cost = {library.id_to_piece(i): -library.get_score(i) for i in plain}  # least first, as a heap gives it
        self._bytes = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self._falls_back = all(map(library.is_byte, self._bytes))
        self._words = re.compile(_word_pattern(list(self._ids))).findall
        self._as_is = library.normalize(" a  b\tc ÅÅ ﬁ Ａ\n ") == f"{SPACE} a  b\tc ÅÅ ﬁ Ａ\n ".replace(" ", SPACE)
        self._now: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}

    def normal(self, text: str) -> str:
        """The text as symbols are cut from it: a blank in front, blanks visible."""
        if not self._as_is:
            return self.library.normalize(text)
        return SPACE + text.replace(" ", SPACE) if text else text

    def merge(self, word: str) -> list[str]:
        """The pieces of a word: pairs that form a piece merge by score, leftmost first."""
        return self._merge_short(word) if len(word) <= SHORT_WORD else self._merge_long(word)

    def _merge_short(self, word: str) -> list[str]:
        """The agenda is the list of the costs of all adjacent pairs; its least entry is looked up."""
        symbols, cost = list(word), self._cost.get
        agenda = [cost(a + b, NO_PIECE) for a, b in zip(symbols, symbols[1:])]
        while agenda and (least := min(agenda)) is not NO_PIECE:
            at = agenda.index(least)
            piece = symbols[at] + symbols[at + 1]
            symbols[at : at + 2] = [piece]
            del agenda[at]
            if at:
                agenda[at - 1] = cost(symbols[at - 1] + piece, NO_PIECE)
            if at < len(agenda):
                agenda[at] = cost(piece + symbols[at + 1], NO_PIECE)
        return symbols

    def _merge_long(self, word: str) -> list[str]:
        """The agenda is a heap of pairs that form a piece.

        An entry is out of date when one of its symbols has been merged away or has grown since. n characters cost
        O(n log n).
        """
        symbols, cost = list(word), self._cost
        last = len(symbols) - 1
        before, after = list(range(-1, last)), list(range(1, last + 2))
        agenda = [(cost[p], i, i + 1, p) for i in range(last) if (p := symbols[i] + symbols[i + 1]) in cost]
        heapify(agenda)
        while agenda:
            _, left, right, piece = heappop(agenda)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != len(piece):
                continue
            symbols[left], symbols[right] = piece, ""
            following = after[left] = after[right]
            if following <= last:
                before[following] = left
                if (p := piece + symbols[following]) in cost:
                    heappush(agenda, (cost[p], left, following, p))
            leading = before[left]
            if leading >= 0 and (p := symbols[leading] + piece) in cost:
                heappush(agenda, (cost[p], leading, left, p))
        return [s for s in symbols if s]

    def _encode_word(self, word: str) -> bytes:
        ids = array("I")
        for piece in self.merge(word):
            known = self._ids.get(piece)
            if known is not None:
                ids.append(known)
            elif self._falls_back:
                ids.extend([self._bytes[b] for b in piece.encode()])
            else:
                ids.append(self.library.unk_id())
        return ids.tobytes()

    def _ids_of(self, word: str) -> bytes:
        ids = self._before.get(word)
        if ids is None:
            ids = self._encode_word(word)
        self._now[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids with the begin and end id, as little-endian unsigned 32-bit integers."""
        if len(self._now) > MEMO_WORDS:
            self._before, self._now = self._now, {}
        known, learn = self._now.get, self._ids_of
        body = b"".join([known(w) or learn(w) for w in self._words(self.normal(text))])
        return array("I", [self.library.bos_id()]).tobytes() + body + array("I", [self.library.eos_id()]).tobytes()


@cache
def encoder(path: str) -> MergeEncoder:
    """One encoder per model file and worker process."""
    return MergeEncoder(path)


def _groups(strings: list[str]) -> Iterator[list[str]]:
    held: list[str] = []
    size = 0
    for s in strings:
        if held and size + len(s) > GROUP_CHARS:
            yield held
            held, size = [], 0
        held.append(s)
        size += len(s)
    if held:
        yield held


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    own = encoder(path)
    library = own.library
    for batch in batches:
        at = 0
        for group in _groups(batch.column("text").to_pylist()):
            wanted = library.encode(group, add_bos=True, add_eos=True, num_threads=1)
            ids = [own.encode(text) for text in group]
            agree = []
            for i, want in enumerate(wanted):
                exact = array("I", want).tobytes()
                agree.append(ids[i] == exact)
                ids[i] = exact
            decoded = library.decode(wanted, num_threads=1)
            keys = batch.column("doc_id").slice(at, len(group))
            yield pa.record_batch([keys, pa.array(ids, pa.binary()), pa.array(decoded, pa.string()), pa.array(agree)], names=["doc_id", "ids", "decoded", "agrees"])
            at += len(group)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded, agrees), one row per document row.

    `ids` are little-endian unsigned 32-bit integers with the begin and end id, `decoded` is what they decode to.
    `agrees` says whether the merges gave the ids of the sentencepiece library, which encodes every batch as a check; where
    they did not, the row has the library's ids. A null or empty text has the begin and end id alone and decodes to an
    empty text. Repeated rows and rows without an id each give a row; an empty table gives an empty result; other
    columns are not read. There is no shuffle. A very long text costs about 60 bytes of a worker's memory a character.
    """
    return texts(docs).mapInArrow(partial(_encode, path=path), ENCODED)


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    library = encoder(path).library
    for batch in batches:
        decoded = [None if x is None else library.decode(np.frombuffer(x, "<u4").tolist()) for x in batch.column("ids").to_pylist()]
        yield pa.record_batch([batch.column("doc_id"), pa.array(decoded, pa.string())], names=["doc_id", "text"])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows with ids as `encode` gives them; ids that are null have a null text."""
    return encoded.select("doc_id", "ids").mapInArrow(partial(_decode, path=path), "doc_id long, text string")
