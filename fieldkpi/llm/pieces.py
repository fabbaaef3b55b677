"""SentencePiece encoding that keeps track of the original bytes, and decoding.

A text is normalised by longest prefixes of the model's compiled character map; every normalised byte remembers the
original byte it comes from, so each piece is projected to a span of the original text.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.llm import frames, text

# The model file's format.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
REPLACEMENT = "�"

#: Segments whose pieces a worker remembers from one part of its texts to the next.
REMEMBERED = 1 << 18
#: Characters of a segment up to which it is merged together with others.
SHORT = 64
#: Symbols from here on are code points that no piece has.
ALIEN = 1 << 22
ENCODED = "doc_id long, ids binary, starts binary, ends binary"

codecs.register_error("fieldkpi-each-byte", lambda e: (REPLACEMENT * (e.end - e.start), e.end))


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message: integers of varint fields, bytes of all others."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        head, at = varint(at)
        kind = head & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at : at + size], at + size
        yield head >> 3, value


class CharacterMap:
    """The compiled map of a normaliser: a double-array trie over UTF-8 keys, and the strings that replace them."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, np.uint32, size // 4, 4).tolist() if blob else []
        self.strings = blob[4 + size :] if blob else b""
        self.first = set(self._children(self._offset(self.units[0]))) if self.units else set()

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def _children(self, base: int) -> Iterator[int]:
        for byte in range(1, 256):
            at = base ^ byte
            if at < len(self.units) and self.units[at] & 0x800000FF == byte:
                yield byte

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """What replaces the longest key that ``data`` has at this place, and the key's length."""
        found, node = None, self._offset(self.units[0]) if self.units else 0
        for k in range(at, len(data) if self.units else at):
            node ^= data[k]
            unit = self.units[node] if node < len(self.units) else 0
            if unit & 0x800000FF != data[k] or not data[k]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                value = self.units[node] & 0x7FFFFFFF
                found = self.strings[value : self.strings.index(0, value)], k + 1 - at
        return found


class Normaliser:
    """Text to normalised text; for each normalised byte, and the end, the original byte it comes from."""

    def __init__(self, spec: bytes, symbols: Iterable[bytes] = (), suffix: bool = False):
        flags = {3: 1, 4: 1, 5: 1} | {n: v for n, v in _fields(spec) if n in (3, 4, 5)}
        self.map = CharacterMap(next((v for n, v in _fields(spec) if n == 2), b""))
        self.prefix, self.trim, escape = (bool(flags[n]) for n in (3, 4, 5))
        self.suffix = suffix
        self.space = SPACE.encode() if escape else b" "
        self.symbols = re.compile(b"|".join(sorted(map(re.escape, symbols), key=len, reverse=True))) if symbols else None
        special = self.map.first | {s[0] for s in symbols} | ({32} if self.trim else set())
        self.special = re.compile(b"[" + b"".join(re.escape(bytes([b])) for b in sorted(special)) + b"]") if special else None

    def _plain(self, data: bytes, first: int) -> tuple[bytes, np.ndarray]:
        """Bytes that no key begins in: only spaces change.  The bytes of a character all come from its first."""
        raw = np.frombuffer(data, np.uint8)
        at = np.maximum.accumulate(np.where(text.code_points(raw), np.arange(len(raw)), 0)) + first
        return data.replace(b" ", self.space), np.repeat(at, np.where(raw == 32, len(self.space), 1))

    def _next(self, data: bytes, at: int) -> tuple[bytes, int]:
        """The normalised form of the prefix at this place, and the prefix's length."""
        own = self.symbols.match(data, at) if self.symbols else None
        if own:
            return own.group(), len(own.group())
        found = self.map.longest(data, at)
        if found:
            return found
        size = 1 if data[at] < 0xC0 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
        return data[at : at + size], size

    def __call__(self, raw: bytes) -> tuple[str, np.ndarray]:
        if not raw:
            return "", np.zeros(1, np.int64)
        try:
            raw.decode()
            clean, back = raw, None
        except UnicodeDecodeError:  # each malformed byte counts as one replacement character
            clean, back = _mended(raw)
        space = self.space
        parts: list[bytes] = []
        origins: list[np.ndarray] = []
        at, after_space = 0, self.trim

        def add(data: bytes, origin: np.ndarray) -> None:
            parts.append(data)
            origins.append(origin)

        while self.trim and at < len(clean):  # spaces at the start
            form, size = self._next(clean, at)
            if form != b" ":
                break
            at += size
        if at == len(clean):
            return "", np.zeros(1, np.int64)
        if self.prefix and not self.suffix:
            add(space, np.full(len(space), at))
        while at < len(clean):
            hit = self.special.search(clean, at) if self.special else None
            stop = hit.start() if hit else len(clean)
            if stop > at:
                add(*self._plain(clean[at:stop], at))
                after_space, at = False, stop
                continue
            form, size = self._next(clean, at)
            form = form.lstrip(b" ") if after_space else form
            if form:
                after_space = self.trim and form.endswith(b" ")
                form = form.replace(b" ", space)
                add(form, np.full(len(form), at))
            at += size
        done, origin = b"".join(parts), np.concatenate([*origins, [len(clean)]])
        while self.trim and done.endswith(space):
            done, origin = done[: -len(space)], origin[: -len(space)]
        if self.prefix and self.suffix:
            done, origin = done + space, np.concatenate([origin[:-1], np.full(len(space) + 1, origin[-1])])
        return done.decode(), origin if back is None else back[origin]


def _mended(raw: bytes) -> tuple[bytes, np.ndarray]:
    """Valid UTF-8, and where each of its bytes, and the end, was."""
    clean = raw.decode("utf-8", "fieldkpi-each-byte")
    back, at = [], 0
    for c in clean:
        own = c.encode()
        same = raw.startswith(own, at)
        back += range(at, at + len(own)) if same else [at] * len(own)
        at += len(own) if same else 1
    return clean.encode(), np.array([*back, at])


class Model:
    """A byte-pair model file of the SentencePiece format."""

    def __init__(self, data: bytes):
        message = list(_fields(data))
        trainer = {n: v for m, body in message if m == 2 for n, v in _fields(body)}
        if trainer.get(3, 1) != BPE:
            raise ValueError("only byte-pair models are encoded here")
        self.pieces, self.scores, self.kinds = [], [], []
        for own in (dict(_fields(body)) for m, body in message if m == 1):
            self.pieces.append(own.get(1, b"").decode())
            self.scores.append(struct.unpack("<f", own.get(2, bytes(4)))[0])
            self.kinds.append(own.get(3, NORMAL))
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] in (NORMAL, USER_DEFINED, UNUSED)}
        self.reserved = {p: i for i, p in enumerate(self.pieces) if p not in self.ids}
        self.unknown = self.kinds.index(UNKNOWN)
        self.bos = self.reserved.get(trainer.get(46, b"<s>").decode())
        self.eos = self.reserved.get(trainer.get(47, b"</s>").decode())
        self.surface = trainer.get(44, " ⁇ ".encode())
        own_symbols = [p.encode() for p, k in zip(self.pieces, self.kinds, strict=True) if k == USER_DEFINED]
        self.symbols = re.compile("|".join(sorted((re.escape(s.decode()) for s in own_symbols), key=len, reverse=True))) if own_symbols else None
        spec, undo = (next((b for m, b in message if m == k), b"") for k in (3, 5))
        if any(n == 2 and v for n, v in _fields(undo)):
            raise ValueError("models with a map for decoded texts are not supported")
        self.normalise = Normaliser(spec, own_symbols, bool(trainer.get(24, 0)))
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        #: The scores by piece, if all of them are plain.
        self.plain = {p: self.scores[i] for p, i in self.ids.items()} if not {USER_DEFINED, UNUSED} & set(self.kinds) else {}
        # no piece holds the start of a word behind another character: words are segmented one by one
        apart = all(SPACE not in p.lstrip(SPACE) for p in self.ids)
        self.segments = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if apart else "(?s).+")
        self.surfaces = [self._surface(i) for i in range(len(self.pieces))]
        self.sizes = np.array([1 if k == BYTE else len(p.encode()) for p, k in zip(self.pieces, self.kinds, strict=True)], np.int64)
        self.controls = np.array([k == CONTROL for k in self.kinds])
        #: Where a known segment's ids begin and how many there are, by the segment's number.
        self._known: dict[str, int] = {}
        self._ids = self._begins = self._counts = np.zeros(0, np.int64)
        self._tables = None
        self.letters: dict[int, str] = {}

    def __getstate__(self) -> dict:
        none = np.zeros(0, np.int64)
        return self.__dict__ | {"_known": {}, "_ids": none, "_begins": none, "_counts": none, "_tables": None}

    def _surface(self, i: int) -> bytes:
        kind, piece = self.kinds[i], self.pieces[i]
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        return b"" if kind == CONTROL else self.surface if kind == UNKNOWN else piece.replace(SPACE, " ").encode()

    def merged(self, segment: str) -> list[str]:
        """The segment's pieces: of all neighbours whose union is a piece the best are joined first, the leftmost of equals."""
        if self.symbols:
            own = [(m.start(), m.end()) for m in self.symbols.finditer(segment)]
            cuts, at = [], 0
            for a, b in [*own, (len(segment), len(segment))]:
                cuts += segment[at:a]
                cuts += [segment[a:b]] if b > a else []
                at = b
            parts, fixed = cuts, {p for p in cuts if self.kinds[self.ids.get(p, self.unknown)] == USER_DEFINED}
        else:
            parts, fixed = list(segment), set()
        before, after = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        queue: list[tuple[float, int, int, str]] = []
        halves: dict[str, tuple[str, str]] = {}

        def offer(a: int, b: int) -> None:
            if a < 0 or b >= len(parts) or parts[a] in fixed or parts[b] in fixed:
                return
            union = parts[a] + parts[b]
            i = self.ids.get(union)
            if i is not None:
                heapq.heappush(queue, (-self.scores[i], a, b, union))
                if self.kinds[i] == UNUSED:
                    halves[union] = parts[a], parts[b]

        for k in range(len(parts) - 1):
            offer(k, k + 1)
        while queue:
            _, a, b, union = heapq.heappop(queue)
            if not parts[a] or not parts[b] or len(parts[a]) + len(parts[b]) != len(union):
                continue
            parts[a], parts[b] = union, ""
            after[a] = after[b]
            if after[b] < len(parts):
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])

        def used(piece: str) -> list[str]:
            return [p for half in halves[piece] for p in used(half)] if piece in halves else [piece]

        return [q for p in parts if p for q in used(p)] if halves else [p for p in parts if p]

    def _pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All unions of two symbols that are pieces, in the order of left * 2 ** 32 + right: that key, the piece, and its
        place among the scores, the best first.  And the symbol of each character, -1 for those that no piece has.

        Symbols are pieces, and behind them the characters that only longer pieces have.
        """
        symbols = dict(self.ids)
        for c in sorted({c for piece in self.ids for c in piece}.difference(self.ids)):
            symbols[c] = len(self.pieces) + len(symbols)
            self.letters[symbols[c]] = c
        halves = [(symbols[p[:k]], symbols[p[k:]], i) for p, i in self.ids.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols]
        left, right, union = np.array(halves or [(0, 0, 0)], np.int64)[: len(halves)].T
        keys = (left << 32) + right
        order = np.argsort(keys)
        places = np.unique(-np.array(self.scores), return_inverse=True)[1]
        of = np.full(0x110000, -1, np.int64)
        for c, i in symbols.items():
            if len(c) == 1:
                of[ord(c)] = i
        return keys[order], union[order], places[union[order]], of

    def _merge_all(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of many segments one after the other, and how many each has; all are one join further in each turn.

        A character that no piece has is ALIEN and its code point.
        """
        if self._tables is None:
            self._tables = self._pairs()
        keys, unions, places, of = self._tables
        never = len(self.pieces) + 1
        letters = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        symbol = of[letters]
        symbol = np.where(symbol < 0, ALIEN + letters, symbol)
        segment = np.repeat(np.arange(len(segments)), [len(s) for s in segments])

        def look(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Place of the union of each symbol with the next one of its segment, and the union."""
            place, union = np.full(len(at), never), np.zeros(len(at), np.int64)
            inner = np.flatnonzero(at + 1 < len(symbol))
            inner = inner[segment[at[inner]] == segment[at[inner] + 1]]
            key = (symbol[at[inner]] << 32) + symbol[at[inner] + 1]
            found = np.minimum(np.searchsorted(keys, key), max(0, len(keys) - 1))
            hit = np.flatnonzero(keys[found] == key) if len(keys) else np.zeros(0, np.int64)
            place[inner[hit]], union[inner[hit]] = places[found[hit]], unions[found[hit]]
            return place, union

        place, union = look(np.arange(len(symbol)))
        done = [(segment[:0], symbol[:0])]
        while len(symbol):
            first = np.flatnonzero(np.diff(segment, prepend=-1))
            best = np.minimum.reduceat(place, first)
            best = np.repeat(best, np.diff(first, append=len(symbol)))
            left = best < never
            if not left.all():
                done.append((segment[~left], symbol[~left]))
                symbol, segment, place, union, best = symbol[left], segment[left], place[left], union[left], best[left]
            at = np.flatnonzero(place == best)
            at = at[np.diff(segment[at], prepend=-1) != 0]  # the leftmost of each segment
            symbol[at] = union[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            at -= np.arange(len(at))  # where they are when the others are gone
            symbol, segment, place, union = symbol[keep], segment[keep], place[keep], union[keep]
            for changed in (at, np.maximum(at - 1, 0)):
                place[changed], union[changed] = look(changed)
        segment, symbol = (np.concatenate(parts) for parts in zip(*done, strict=True))
        order = np.argsort(segment, kind="stable")
        return symbol[order], np.bincount(segment, minlength=len(segments))

    def _spelled(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids in place of symbols that are no piece: their bytes, or unknown, where unknown neighbours are one."""
        odd = np.flatnonzero(symbols >= len(self.pieces))
        if not len(odd):
            return symbols, counts
        letters = {s: chr(s - ALIEN) if s >= ALIEN else self.letters[s] for s in np.unique(symbols[odd]).tolist()}
        if self.bytes:
            spelled = {s: [self.bytes[b] for b in c.encode()] for s, c in letters.items()}
        else:
            spelled = dict.fromkeys(letters, [self.unknown])
        lists = [spelled[s] for s in symbols[odd].tolist()]
        size = np.ones(len(symbols), np.int64)
        size[odd] = [len(x) for x in lists]
        owner = np.repeat(np.repeat(np.arange(len(counts)), counts), size)
        ids = np.repeat(symbols, size)
        ids[np.repeat(symbols >= len(self.pieces), size)] = list(chain.from_iterable(lists))
        if not self.bytes:
            keep = np.ones(len(ids), bool)
            keep[1:] = (ids[1:] != self.unknown) | (ids[:-1] != self.unknown) | (owner[1:] != owner[:-1])
            ids, owner = ids[keep], owner[keep]
        return ids, np.bincount(owner, minlength=len(counts))

    def _learn(self, segments: set[str]) -> None:
        """Take up the ids of segments that are not known yet."""
        new = segments.difference(self._known)
        if len(self._known) + len(new) > REMEMBERED:
            self._known.clear()
            self._ids, self._begins, self._counts = (np.zeros(0, np.int64),) * 3
            new = segments
        short = [s for s in new if len(s) <= SHORT] if self.plain else []
        parts = [self._spelled(*self._merge_all(short))]
        order = short
        for segment in new.difference(short):
            ids = self._segment(segment)
            parts.append((np.array(ids, np.int64), np.array([len(ids)])))
            order.append(segment)
        counts = np.concatenate([p[1] for p in parts])
        begins = len(self._ids) + text.exclusive(counts) if len(counts) else counts
        self._known.update(zip(order, range(len(self._counts), len(self._counts) + len(order)), strict=True))
        self._ids = np.concatenate([self._ids, *[p[0] for p in parts]])
        self._begins, self._counts = np.concatenate([self._begins, begins]), np.concatenate([self._counts, counts])

    def _segment(self, segment: str) -> list[int]:
        """Ids; unknown neighbours are one where the model has no byte pieces."""
        ids: list[int] = []
        for piece in self.merged(segment):
            i = self.reserved.get(piece, self.ids.get(piece, self.unknown))
            if i == self.unknown and self.bytes:
                ids += [self.bytes[b] for b in piece.encode()]
            elif i != self.unknown or ids[-1:] != [i]:
                ids.append(i)
        return ids

    def _covered(self, normal: str, ids: np.ndarray) -> np.ndarray:
        """How many normalised bytes each id covers."""
        sizes = self.sizes[ids]
        if not self.bytes and (ids == self.unknown).any():
            body, at = normal.encode(), 0
            for k, i in enumerate(ids.tolist()):
                if i == self.unknown:  # up to where the rest begins
                    after = self.pieces[ids[k + 1]].encode() if k + 1 < len(ids) else None
                    sizes[k] = (body.index(after, at + 1) if after else len(body)) - at
                at += int(sizes[k])
        return sizes

    def encode_all(self, raws: Sequence[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of each text the ids with begin and end ids, and the original bytes [start, end) of each; those two cover nothing."""
        normal = [self.normalise(raw) for raw in raws]
        segments = [self.segments.findall(n) for n, _ in normal]
        joined = list(chain.from_iterable(segments))
        self._learn(set(joined))
        at = np.fromiter(map(self._known.__getitem__, joined), np.int64, len(joined))
        counts = self._counts[at]
        every = self._ids[np.repeat(self._begins[at] - text.exclusive(counts), counts) + np.arange(counts.sum())] if len(at) else at
        cuts = np.concatenate([[0], np.cumsum(counts)])[np.cumsum([0, *map(len, segments)])]
        out = []
        for raw, (form, origin), a, b in zip(raws, normal, cuts[:-1], cuts[1:], strict=True):
            ids = every[a:b]
            bounds = np.zeros(len(ids) + 1, np.int64)
            np.cumsum(self._covered(form, ids), out=bounds[1:])
            at = origin[bounds]
            packed = np.concatenate([[self.bos], ids, [self.eos]]).astype(np.uint32)
            starts, ends = np.concatenate([[0], at[:-1], [len(raw)]]), np.concatenate([[0], at[1:], [len(raw)]])
            out.append((packed, starts.astype(np.uint32), ends.astype(np.uint32)))
        return out

    def encode(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.encode_all([raw])[0]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no character become replacement characters, one by one."""
        listed = ids.tolist()
        surfaces = list(map(self.surfaces.__getitem__, listed))
        spaced = self.normalise.prefix or self.normalise.trim
        for k, i in enumerate(listed):  # the space that encoding put before the text
            if self.kinds[i] not in (CONTROL, BYTE, UNKNOWN) and spaced and surfaces[k].startswith(b" "):
                surfaces[k] = surfaces[k][1:]
                if surfaces[k] or not self.normalise.trim:
                    break
            elif surfaces[k]:
                break
        # bytes on both sides of a control piece are no character together
        cuts = [-1, *np.flatnonzero(self.controls[ids]).tolist(), len(listed)]
        return "".join(b"".join(surfaces[a + 1 : b]).decode("utf-8", "fieldkpi-each-byte") for a, b in pairwise(cuts))


def load(path: str) -> Model:
    """The model of a file that the driver reads; executors get it by broadcast, as large as the file."""
    with open(path, "rb") as file:
        return Model(file.read())


def encoded(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, ids, starts, ends of every document, all three as little-endian unsigned 32-bit numbers.

    ids are those of the model with begin and end ids; starts and ends are the original bytes that each piece covers
    (those of a character spelled out in byte pieces are at the last of them).  Null text is empty: begin and end id
    alone.  Null ids stay null, repeated rows each give a row, an empty table gives none; other columns are ignored.
    Nothing is shuffled; a worker holds a few MB of texts, or one document, at a time.
    """
    return _encoded(docs, model, False)


def _encoded(docs: DataFrame, model: Model, again: bool) -> DataFrame:
    """``encoded``, with ``again`` also the text that the ids decode to."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "ids", "starts", "ends", *(["text"] if again else [])]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for batch in batches:
            for part in text.slices(batch.column(1)):
                body, ends = part.data.tobytes(), part.offsets.tolist()
                rows = held.encode_all([body[a:b] for a, b in pairwise(ends)])
                columns = [pa.array([r[k].astype("<u4", copy=False).tobytes() for r in rows], pa.binary()) for k in range(3)]
                if again:
                    columns.append(pa.array([held.decode(r[0]) for r in rows], pa.string()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.first, len(rows)), *columns], names)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    return rows.mapInArrow(run, ENCODED + (", text string" if again else ""))


def decoded(rows: DataFrame, model: Model) -> DataFrame:
    """The rows of ``encoded`` (doc_id, ids) with the text of their ids in place of the spans: doc_id, ids, text.

    Null ids give null text.
    """
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = sent.value
        texts = [None if b is None else held.decode(np.frombuffer(b, "<u4")) for b in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return frames.per_batch(rows.select("doc_id", "ids"), run, "doc_id long, ids binary, text string")


def spans(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, at, id, piece, start, end: one row for each piece of ``encoded`` rows, numbered from 0."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(sent.value.pieces, object)
        for batch in batches:
            for doc, *packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, starts, ends = (np.frombuffer(p, "<u4") for p in packed)
                columns = [pa.array(np.arange(len(ids))), pa.array(ids.astype(np.int64)), pa.array(names[ids], pa.string())]
                columns += [pa.array(starts.astype(np.int64)), pa.array(ends.astype(np.int64))]
                yield pa.RecordBatch.from_arrays([pa.array([doc] * len(ids), pa.int64()), *columns], ["doc_id", "at", "id", "piece", "start", "end"])

    return rows.select("doc_id", "ids", "starts", "ends").mapInArrow(run, "doc_id long, at long, id long, piece string, start long, end long")


def digests(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document, encoded and decoded again."""
    return _encoded(docs, model, True).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


