"""SentencePiece encoding by a merge-type prefix table, and decoding.

The last token of the encoding of a prefix is unique: among the pieces that end there (an automaton finds them) it is the one that
is compatible with the last token of the prefix before it. Two tokens are compatible if merging their joined characters gives just
these two, which their merge histories along the seam tell. So one pass stores a last token per prefix, and the ids are read backwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from sentencepiece import SentencePieceProcessor

from rivulet.llm.common import id_and_text

SCHEMA = "doc_id bigint, ids array<int>, decoded string"
SPACE = "▁"  # how the model writes a space
_NEVER = float("inf")
_UNKNOWN, _START = -1, -2


class Codec:
    """Encoder and decoder of a BPE model with byte fallback, identity normalisation and a space put before the text.

    ``kept`` bounds the table of pairs, which is emptied when full, and that of encoded segments: when it is full it becomes the older
    one, from which segments that come again are taken over. Models of another kind raise ValueError.
    """

    def __init__(self, model: bytes, kept: int = 1 << 18) -> None:
        library = SentencePieceProcessor(model_proto=model)
        size = library.get_piece_size()
        pieces = [library.id_to_piece(i) for i in range(size)]
        if library.normalize("Ａ  é ") != f"{SPACE}Ａ{SPACE}{SPACE}é{SPACE}":
            raise ValueError("the model changes characters or white space")
        self.bytes_ = {int(p[1:-1], 16): i for i, p in enumerate(pieces) if library.is_byte(i)}
        special = {i for i in range(size) if library.is_control(i) or library.is_unknown(i) or library.is_byte(i)}
        if len(self.bytes_) != 256 or any(library.is_unused(i) for i in range(size)):
            raise ValueError("the model lacks byte fallback or has unused pieces")
        self.size, self.pieces = size, pieces
        self.ids = {p: i for i, p in enumerate(pieces) if i not in special}
        self.rank = [-library.get_score(i) for i in range(size)]
        self.byte_of = {i: b for b, i in self.bytes_.items()}
        self.shown = ["" if i in special else p.replace(SPACE, " ") for i, p in enumerate(pieces)]
        self.kept = kept
        self._histories()
        self.pairs: dict[int, bool] = {}
        self.segments: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        #: No piece has a space after another character, so no merge crosses such a place and segments are encoded alone.
        apart = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.segment = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if apart else "(?s:.+)")

    def _histories(self) -> None:
        """For each piece, the symbols along its left and its right edge from the single character on, each with the rank of the merge that ends it."""
        ids, size = self.ids, self.size
        self.merge = merge = {}
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                a, b = ids.get(piece[:cut]), ids.get(piece[cut:])
                if a is not None and b is not None:
                    merge[a * size + b] = self.rank[i]
        #: Pieces whose parts do not merge strictly before them (runs of spaces, all of one rank): their pairs are merged step by step.
        self.tied: set[int] = set()
        self.left: dict[int, list] = {}
        self.right: dict[int, list] = {}
        for piece, i in sorted(ids.items(), key=lambda entry: self.rank[entry[1]]):
            if len(piece) == 1:
                self.left[i] = self.right[i] = [(i, _NEVER)]
        for piece, i in sorted(ids.items(), key=lambda entry: self.rank[entry[1]]):
            if any(c not in ids for c in piece):
                raise ValueError(f"a character of {piece!r} is not a piece")
            ends = self.rank[i]
            for cut in range(1, len(piece)):
                a, b = ids.get(piece[:cut]), ids.get(piece[cut:])
                if self._earlier(a, ends) and self._earlier(b, ends) and self._seam(a, b, ends):
                    self.left[i] = [*self.left[a][:-1], (a, ends), (i, _NEVER)]
                    self.right[i] = [*self.right[b][:-1], (b, ends), (i, _NEVER)]
                    break
            else:
                if len(piece) > 1 and self._merged(piece) == [i]:
                    self.tied.add(i)
        self.automaton = ahocorasick.Automaton()
        for piece, i in ids.items():
            if i in self.left or i in self.tied:
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()

    def _earlier(self, part: int | None, rank: float) -> bool:
        return part in self.right and (len(self.pieces[part]) == 1 or self.rank[part] < rank)

    def _merged(self, text: str) -> list[int]:
        """The encoding by merging step by step: only for a piece or two."""
        symbols = [self.ids[c] for c in text]
        while True:
            best = min(((self.merge.get(a * self.size + b, _NEVER), k) for k, (a, b) in enumerate(zip(symbols, symbols[1:]))), default=(_NEVER, 0))
            if best[0] == _NEVER:
                return symbols
            k = best[1]
            symbols[k : k + 2] = [self.ids[self.pieces[symbols[k]] + self.pieces[symbols[k + 1]]]]

    def _seam(self, a: int, b: int, own: float = _NEVER) -> bool:
        """Whether no merge crosses the seam between two tokens; a merge of both as a whole counts unless it has rank ``own``.

        Both edges are followed in the order of their merges. Equal ranks merge from the left, so the left token's goes first,
        then one across the seam, then the right token's.
        """
        lefts, rights = self.right[a], self.left[b]
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = lefts[i], rights[j]
            across = self.merge.get(x * self.size + y, _NEVER)
            if x_ends == y_ends == _NEVER:
                return across == _NEVER or across == own
            if across < x_ends and across <= y_ends:
                return False
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def _fit(self, a: int, b: int) -> bool:
        if a in self.tied or b in self.tied:
            return self._merged(self.pieces[a] + self.pieces[b]) == [a, b]
        return self._seam(a, b)

    def _segment(self, text: str) -> tuple[int, ...]:
        last = [_UNKNOWN] * (len(text) + 1)
        last[0] = _START
        pairs, size = self.pairs, self.size
        for end, (token, length) in self.automaton.iter(text):
            if last[end + 1] >= 0:
                continue
            before = last[end + 1 - length]
            if before >= 0:
                key = before * size + token
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= self.kept:
                        pairs.clear()
                    fits = pairs[key] = self._fit(before, token)
                if not fits:
                    continue
            last[end + 1] = token
        ids, at = [], len(text)
        while at:
            token = last[at]
            if token >= 0:
                ids.append(token)
                at -= len(self.pieces[token])
            else:
                at -= 1
                ids.extend(self.bytes_[b] for b in reversed(text[at].encode()))
        return tuple(reversed(ids))

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        found = self.segment.findall(SPACE + text.replace(" ", SPACE))
        if len(self.segments) >= self.kept:
            self.older, self.segments = self.segments, {}
        kept, older = self.segments, self.older
        for segment in found:
            if segment not in kept:
                ids = older.get(segment)
                kept[segment] = self._segment(segment) if ids is None else ids
        return list(chain.from_iterable(map(kept.__getitem__, found)))

    def decode(self, ids: list[int]) -> str:
        """Pieces joined, runs of byte tokens read as UTF-8 (bytes that are none: U+FFFD each), without the space put before the text."""
        if self.byte_of.keys().isdisjoint(ids):
            text = "".join(map(self.shown.__getitem__, ids))
        else:
            parts, run = [], bytearray()
            for i in ids:
                if i in self.byte_of:
                    run.append(self.byte_of[i])
                    continue
                parts += [_utf8(run), self.shown[i]]
                run.clear()
            text = "".join([*parts, _utf8(run)])
            if ids[0] in self.byte_of:
                return text
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=1)
def _codec(model: bytes) -> Codec:
    """One per worker process, for all its tasks."""
    return Codec(model)


def _utf8(run: bytearray) -> str:
    out, at = [], 0
    while at < len(run):
        try:
            out.append(run[at:].decode())
            break
        except UnicodeDecodeError as fault:
            out += [run[at : at + fault.start].decode(), "�"]
            at += fault.start + 1
    return "".join(out)


def coded(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id, the ids of its whole text, and the text decoded from these.

    ``model_path`` is read on the driver; the model, some 0.5 MB whatever the table, goes to the tasks. Null and empty texts have no ids and
    decode to an empty text; a null id stays null; repeated rows come out as often as they go in; other columns, whatever their
    names, are left behind; an empty table gives an empty table. Very long texts are one pass over a table of one token a character.
    """
    with open(model_path, "rb") as file:
        model = file.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                ids = [codec.encode(t) for t in some["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some["id"], pa.array(ids, pa.list_(pa.int32())), pa.array([codec.decode(i) for i in ids], pa.string())],
                    ["doc_id", "ids", "decoded"],
                )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
