"""SentencePiece encoding and decoding for merge-type vocabularies.

``Agenda`` encodes a text as the library does: the text becomes symbols (characters), every adjacent pair that
forms a piece goes on an agenda ordered by score, then by place, and the best pair is merged until none is left.
Characters without a piece fall back to bytes. ``ManyAgendas`` does the same for many short segments at once, each
round taking the best pair of every segment's agenda; long segments and rare characters go to ``Agenda``. No piece of such a vocabulary goes on past a word (none has the
space mark after another character), so a text falls into segments - a run of space marks and what
follows - that are encoded one by one, with the same result; each distinct segment of a slice is encoded once.
``Agenda`` checks that property of the vocabulary and encodes whole texts where it does not hold.

Every Arrow batch's new segments are also encoded by the sentencepiece library and compared; a difference
raises. The vocabulary file is a parameter and read on each executor.

Defined cases: a null text counts as empty and gives the end id alone; very long texts without spaces cost
n log n; repeated rows are encoded one by one; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Sequence
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from thermopanel.llm.common import per_text, ragged

MARK = "▁"
#: Distinct segments remembered by a task; bounds its memory.
REMEMBERED = 400_000


class Agenda:
    def __init__(self, path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.places = {self.pieces[i]: -sp.get_score(i) for i in plain}
        self.ids = {self.pieces[i]: i for i in plain}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown, self.end = sp.unk_id(), sp.eos_id()
        self.spoken = frozenset(plain)
        self.silent = {i for i in range(n) if sp.is_control(i)}
        self.digits = [b"%d " % i for i in range(n)]
        self.by_segment = not any(MARK in p.lstrip(MARK) for p in self.ids)

    def encode(self, text: str) -> list[int]:
        """Ids of a text whose spaces are marks already."""
        symbols = list(text)
        n = len(symbols)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        place, push, pop = self.places.get, heapq.heappush, heapq.heappop
        # (negative score, left symbol, right symbol, piece), the best pair first
        agenda = [(at, i, i + 1, piece) for i, piece in enumerate(map(add, symbols, symbols[1:])) if (at := place(piece)) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, i, j, piece = pop(agenda)
            # stale unless both symbols still stand and make up the piece
            if right[i] != j or not symbols[i] or symbols[i] + symbols[j] != piece:
                continue
            symbols[i], symbols[j] = piece, ""
            before, after = left[i], right[j]
            right[i] = after
            if after >= 0:
                left[after] = i
                longer = piece + symbols[after]
                if (at := place(longer)) is not None:
                    push(agenda, (at, i, after, longer))
            if before >= 0:
                longer = symbols[before] + piece
                if (at := place(longer)) is not None:
                    push(agenda, (at, before, i, longer))
        out: list[int] = []
        for symbol in symbols:
            if symbol:
                found = self.ids.get(symbol)
                if found is not None:
                    out.append(found)
                elif self.bytes:
                    out += [self.bytes[b] for b in symbol.encode()]
                else:
                    out.append(self.unknown)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids: marks are spaces, bytes are joined, the mark put before the text goes."""
        text = self.plain(ids)
        return text[1:] if text.startswith(" ") else text

    def plain(self, ids: list[int]) -> str:
        if self.spoken.issuperset(ids):
            return "".join(map(self.pieces.__getitem__, ids)).replace(MARK, " ")
        out, held = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            if i == self.unknown:
                out.append(" ⁇ ")
            elif i not in self.silent:
                out.append(self.pieces[i])
        if held:
            out.append(held.decode("utf-8", "replace"))
        return "".join(out).replace(MARK, " ")

    def check(self, segments: list[str], ids: list[list[int]]) -> None:
        """Compare with the library. A segment goes in as it stands in a text: its first mark is put there."""
        plain = [s[1:].replace(MARK, " ") if s.startswith(MARK) else None for s in segments]
        known = [i for i, s in enumerate(plain) if s is not None and s]
        theirs = self.library.encode([plain[i] for i in known], num_threads=1)
        for i, right in zip(known, theirs):
            if ids[i] != right:
                raise ValueError(f"encoding differs from the library's: {segments[i]!r}")


class ManyAgendas:
    """The agendas of many short segments side by side, as arrays.

    Symbols are numbers of pieces. The pairs that form a piece stand in a hash table (pair -> score, piece), so a round
    is: the best pair of each segment, its merge, and the scores of the merged symbol's two new pairs.
    """

    LONGEST = 40
    FREE = np.uint64(2**64 - 1)
    NEVER = np.float32(np.inf)

    def __init__(self, agenda: Agenda):
        pieces = list(agenda.ids)
        self.known = {p: i for i, p in enumerate(pieces)}
        self.ids = np.array(list(agenda.ids.values()), np.int64)
        self.letters = np.full(0x110000, -1, np.int32)
        for p, i in self.known.items():
            if len(p) == 1:
                self.letters[ord(p)] = i
        pairs = [(a, b, i) for p, i in self.known.items() for k in range(1, len(p))
                 if (a := self.known.get(p[:k])) is not None and (b := self.known.get(p[k:])) is not None]
        # a piece part of which is no piece is out of reach for the arrays only if that part is one character
        self.complete = all(self.letters[ord(c)] >= 0 for p in pieces for c in p)
        left, right, whole = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 3
        places = np.array([agenda.places[p] for p in pieces], np.float32)
        self.bits = max(10, int(len(pairs) * 4).bit_length())
        self.keys = np.full(1 << self.bits, self.FREE)
        self.score, self.merged = np.full(1 << self.bits, self.NEVER), np.zeros(1 << self.bits, np.int32)
        keys = self._key(left, right)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] == self.FREE]
            self.keys[slot[free]] = keys[free]          # of several the last one stays
            done = self.keys[slot[todo]] == keys[todo]
            at = slot[todo[done]]
            self.score[at], self.merged[at] = places[whole[todo[done]]], whole[todo[done]]
            todo = todo[~done]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair; one that forms no piece gets a free slot, whose score is ``NEVER``."""
        keys = self._key(left, right)
        slot = self._slot(keys)
        there = self.keys[slot]
        todo = np.flatnonzero((there != keys) & (there != self.FREE))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[todo]]
            todo = todo[(there != keys[todo]) & (there != self.FREE)]
        return slot

    def _merge(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges rows of equally many symbols; returns the symbols and how many stand in each row."""
        n, width = symbols.shape
        sizes = np.full(n, width)
        if width < 2:
            return symbols, sizes
        slots = self._find(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())
        score, slots = self.score[slots].reshape(n, width - 1), slots.reshape(n, width - 1)
        out, rows = symbols.copy(), np.arange(n)
        column = np.arange(width)
        while True:
            at = score.argmin(axis=1)                     # the leftmost of equals
            each = np.arange(len(rows))
            going = score[each, at] < self.NEVER
            out[rows[~going], :symbols.shape[1]] = symbols[~going]
            if not going.any():
                return out, sizes
            if not going.all():
                rows, symbols, score, slots, at = rows[going], symbols[going], score[going], slots[going], at[going]
                each = np.arange(len(rows))
            sizes[rows] -= 1
            width = symbols.shape[1] - 1
            new = self.merged[slots[each, at]]
            # what is right of the pair moves one place to the left
            take = column[:width] + (column[:width] > at[:, None])
            symbols = np.take_along_axis(symbols, take, 1)
            symbols[each, at] = new
            if width < 2:
                out[rows, :width] = symbols
                return out, sizes
            take = column[:width - 1] + (column[:width - 1] >= at[:, None])
            score, slots = np.take_along_axis(score, take, 1), np.take_along_axis(slots, take, 1)
            for pair in (at - 1, at):
                some = np.flatnonzero((pair >= 0) & (pair < width - 1))
                p = pair[some]
                found = self._find(symbols[some, p], symbols[some, p + 1])
                score[some, p], slots[some, p] = self.score[found], found

    def encode(self, texts: list[str]) -> list[list[int] | None]:
        """Ids of each text; None where the text is for ``Agenda``."""
        out: list[list[int] | None] = [None] * len(texts)
        if not self.complete:
            return out
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        for length in np.unique(lengths[(lengths > 0) & (lengths <= self.LONGEST)]).tolist():
            mine = np.flatnonzero(lengths == length)
            letters = np.frombuffer("".join([texts[i] for i in mine.tolist()]).encode("utf-32-le"), np.uint32).reshape(-1, length)
            symbols = self.letters[letters]
            fit = (symbols >= 0).all(axis=1)
            mine = mine[fit]
            found, sizes = self._merge(symbols[fit])
            for i, size, row in zip(mine.tolist(), sizes.tolist(), self.ids[found].tolist()):
                out[i] = row[:size]
        return out


class Encoder:
    """Encodes slices of texts; remembers the segments it has met."""

    def __init__(self, path: str):
        self.agenda = Agenda(path)
        self.many = ManyAgendas(self.agenda)
        self.number: dict[bytes, int] = {}
        self._reset()

    def _reset(self, keep: Sequence[int] = ()) -> None:
        """Forget all segments but those with these numbers."""
        segments = list(self.number) if len(keep) else []
        self.number = {segments[i]: n for n, i in enumerate(keep)}
        self.counts: list[int] = [self.counts[i] for i in keep]
        self.ids_text: list[bytes] = [self.ids_text[i] for i in keep]
        self.plain: list[bytes] = [self.plain[i] for i in keep]
        self.last = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep what the last slice had more than once, the most frequent segments first, up to half of the memory."""
        often = np.bincount(self.last, minlength=len(self.counts))
        again = np.flatnonzero(often > 1)
        self._reset(again[np.argsort(-often[again], kind="stable")][:REMEMBERED // 2].tolist())

    def _learn(self, segments: list[bytes]) -> None:
        strings = [s.decode() for s in segments]
        ids = [self.agenda.encode(s) if found is None else found for s, found in zip(strings, self.many.encode(strings))]
        self.agenda.check(strings, ids)
        self.number.update(zip(segments, range(len(self.counts), len(self.counts) + len(segments))))
        self.counts += map(len, ids)
        digits = self.agenda.digits.__getitem__
        self.ids_text += [b"".join(map(digits, found)) for found in ids]
        # a segment's bytes are whole characters, so it decodes apart from the text around it
        # pieces that stand for themselves join to the segment they were cut from
        mark, spoken = MARK.encode(), self.agenda.spoken.issuperset
        self.plain += [
            s.replace(mark, b" ") if spoken(found) else self.agenda.plain(found).encode() for s, found in zip(segments, ids)
        ]

    def run(self, column: pa.Array) -> dict:
        mark = MARK.encode()
        if len(self.number) > REMEMBERED:
            self._forget()
        lists: list[list[bytes]] = []
        texts = [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]
        for text in texts:
            lists.append(self._cut(mark + text.replace(b" ", mark)) if text else [])
        new = set(chain.from_iterable(lists)).difference(self.number)
        if new:
            self._learn(list(new))
        numbers = np.fromiter(map(self.number.__getitem__, chain.from_iterable(lists)), np.int64)
        self.last = numbers
        sizes = np.array([len(x) for x in lists], np.int64)
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        counts = np.concatenate(([0], np.cumsum(np.asarray(self.counts, np.int64)[numbers] if len(numbers) else np.zeros(0, np.int64))))
        used, inverse = np.unique(numbers, return_inverse=True)
        ids, plain = (self._joined(pool, used.tolist(), inverse, bounds) for pool in (self.ids_text, self.plain))
        end = b"%d" % self.agenda.end
        return {
            "n_tokens": counts[bounds[1:]] - counts[bounds[:-1]] + 1,
            "ids_sha256": [hashlib.sha256(x + end).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(x[1:] if x[:1] == b" " else x).hexdigest() for x in plain],
        }

    def _cut(self, text: bytes) -> list[bytes]:
        if not self.agenda.by_segment:
            return [text]
        mark = MARK.encode()
        parts = text.split(mark)
        # the text begins with a mark, so parts[0] is empty; an empty part is a further mark of the next segment
        if all(parts[1:]):
            return [mark + part for part in parts[1:]]
        out, run = [], 0
        for part in parts[1:]:
            run += 1
            if part:
                out.append(mark * run + part)
                run = 0
        if run:
            out.append(mark * run)
        return out

    @staticmethod
    def _joined(pool: list[bytes], used: list[int], inverse: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Per text, the stretches of its segments one after the other."""
        parts = [pool[i] for i in used]
        lengths = np.array([len(x) for x in parts], np.int64)
        starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        data = ragged(np.frombuffer(b"".join(parts), np.uint8), starts[inverse], lengths[inverse]) if len(inverse) else np.zeros(0, np.uint8)
        ends = np.concatenate(([0], np.cumsum(lengths[inverse]) if len(inverse) else []))[bounds].astype(np.int64)
        whole = data.tobytes()
        return [whole[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


FIELDS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, number of ids with the end id, digests of the ids and of the decoded text."""

    def work():
        encoder = Encoder(path)
        return lambda batch: encoder.run(batch.column(batch.schema.get_field_index("text")))

    return per_text(docs, "doc_id long", FIELDS, work)
