"""Exact encoding and decoding with a byte-level BPE rank file, without a regex.

The pattern that cuts a text into pieces is a machine of eight states over nine
symbols. A symbol is the class of a code point (letter, number, white space,
other) together with what follows it (white space before more white space, an
apostrophe before a contraction), so every array step is local. A symbol acts on
the states as a function; the functions that arise from composing them are few,
and composing two is one look-up in a table. The state before every code point is
thus an associative scan of look-ups over numpy arrays, and the cuts are the
positions at which a state and a symbol begin a piece.

Each piece is merged by rank once and remembered per worker (bounded in bytes).
Ids of a slice of texts lie in one flat array; decoding gathers the bytes of the
vocabulary by id through an offset table.

The classes are those of the installed tiktoken library (its own Unicode tables),
read once on the driver.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import add_columns

# classes of code points
OTHER, LETTER, NUMBER, SPACE = range(4)
# symbols
_L, _N, _O, _SHORT, _LONG, _MORE, _BLANK, _LAST, _END = range(9)
# states: a new piece starts next; inside letters, numbers, others, white space;
# after a blank that belongs to the next piece; one, two letters of a contraction left
_NEW, _IN_L, _IN_N, _IN_O, _IN_S, _PREFIX, _ONE, _TWO = range(8)

SLICE_CHARS = 1 << 20    # code points worked on at once
LONG_CHARS = 1 << 22     # longer texts are cut before blanks, where a piece always starts
CACHE_BYTES = 48 << 20   # of remembered pieces per worker
CACHE_CHARS = 64         # longer pieces are not looked up again
_BLOCK = 256             # length of the scanned blocks
_SHORT_PIECE = 48        # bytes up to which pieces are merged in batches
_BATCH = 1 << 15         # pieces merged together
_NONE = np.int32(2**31 - 1)


def _machine():
    """Next state and "a piece starts here" for each symbol and state."""
    step = np.zeros((9, 8), dtype=np.uint8)
    starts = np.ones((9, 8), dtype=bool)
    for symbol, run in ((_L, _IN_L), (_N, _IN_N), (_O, _IN_O)):
        step[symbol] = run
        starts[symbol, [run, _PREFIX]] = False
    for symbol, state in ((_SHORT, _ONE), (_LONG, _TWO)):  # an apostrophe and a contraction
        step[symbol] = state
        step[symbol, [_IN_O, _PREFIX]] = _IN_O
        starts[symbol, [_IN_O, _PREFIX]] = False
    step[_L, _ONE], step[_L, _TWO] = _NEW, _ONE
    starts[_L, [_ONE, _TWO]] = False
    step[_MORE] = _IN_S   # white space that is not the last before other text
    starts[_MORE, _IN_S] = False
    step[_BLANK] = _PREFIX
    step[_LAST] = _NEW
    step[_END] = _NEW
    return step, starts


@lru_cache(maxsize=1)
def _monoid():
    """(function of each symbol, composition table, functions as state maps)."""
    step, _ = _machine()
    maps = [tuple(range(8))]
    number = {maps[0]: 0}
    for row in step.tolist():
        if tuple(row) not in number:
            number[tuple(row)] = len(maps)
            maps.append(tuple(row))
    generators = [number[tuple(row)] for row in step.tolist()]
    at = 0
    while at < len(maps):
        for g in set(generators):
            made = tuple(maps[g][s] for s in maps[at])
            if made not in number:
                number[made] = len(maps)
                maps.append(made)
        at += 1
    table = np.empty((len(maps), len(maps)), dtype=np.uint16)
    for a, first in enumerate(maps):
        for b, then in enumerate(maps):
            table[a, b] = number[tuple(then[s] for s in first)]
    return np.array(generators, dtype=np.uint16), table, np.array(maps, dtype=np.uint8)


def _scan(functions: np.ndarray) -> np.ndarray:
    """Inclusive scan: the composition of the functions up to each position."""
    _, table, _ = _monoid()
    size, n = table.shape[0], len(functions)
    flat = table.ravel()
    if n <= _BLOCK:
        out = np.empty(n, dtype=np.uint16)
        held = 0
        for k, f in enumerate(functions.tolist()):
            held = int(flat[held * size + f])
            out[k] = held
        return out
    rows = -(-n // _BLOCK)
    padded = np.zeros(rows * _BLOCK, dtype=np.uint16)  # 0 is the identity
    padded[:n] = functions
    columns = np.ascontiguousarray(padded.reshape(rows, _BLOCK).T)
    inside = np.empty_like(columns)
    held = np.zeros(rows, dtype=np.intp)
    for k in range(_BLOCK):  # all blocks advance together
        held = flat[held * size + columns[k]].astype(np.intp)
        inside[k] = held
    before = np.zeros(rows, dtype=np.intp)
    before[1:] = _scan(inside[-1])[:-1]
    return flat[before * size + inside].T.reshape(-1)[:n]


def piece_starts(points: np.ndarray, ends: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Positions of ``points`` at which a piece starts, and every one of ``ends``.

    ``ends`` are the positions of the separators that close each text.
    """
    kind = classes[points]
    kind[ends] = SPACE  # the end of a text ends white space like more of it
    space = kind == SPACE
    symbol = np.full(len(points), _O, dtype=np.uint8)
    symbol[kind == LETTER] = _L
    symbol[kind == NUMBER] = _N
    more = np.append(space[1:], True)
    symbol[space & more] = _MORE
    last = space & ~more
    symbol[last] = _LAST
    symbol[last & (points == 32)] = _BLANK
    quote = np.flatnonzero(points[:-1] == 39)  # the last code point is a separator
    if len(quote):
        one = points[quote + 1]
        two = points[np.minimum(quote + 2, len(points) - 1)]
        s, t, m, d, r, e, v, el = map(ord, "stmdrevl")
        symbol[quote[(one == s) | (one == t) | (one == m) | (one == d)]] = _SHORT
        symbol[quote[(((one == r) | (one == v)) & (two == e)) | ((one == el) & (two == el))]] = _LONG
    symbol[ends] = _END
    generators, _, maps = _monoid()
    state = np.zeros(len(points), dtype=np.uint8)
    state[1:] = maps[_scan(generators[symbol])[:-1], _NEW]
    _, starts = _machine()
    return np.flatnonzero(starts[symbol, state])


@dataclass
class Ranks:
    """Token bytes by id and the classes of all code points (fixed size)."""
    tokens: list[bytes]
    classes: np.ndarray


@lru_cache(maxsize=2)
def load_ranks(path: str) -> Ranks:
    """Read a rank file; ranks must be 0, 1, 2, ... and hold every single byte."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    tokens = [b""] * len(pairs)
    for word, rank in pairs:
        tokens[int(rank)] = base64.b64decode(word)
    if b"" in tokens or not {bytes([b]) for b in range(256)} <= set(tokens):
        raise ValueError("ranks must be dense and hold every byte")
    return Ranks(tokens, _classes())


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point, as the library's own patterns see it."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    classes = np.full(0x110000, OTHER, dtype=np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        probe = tiktoken.Encoding("probe", pat_str=pattern, special_tokens={},
                                  mergeable_ranks={bytes([b]): b for b in range(256)})
        found = bytes(probe.encode_ordinary(every)).decode("utf-8")  # what matches, in order
        classes[np.frombuffer(found.encode("utf-32-le"), dtype=np.uint32)] = kind
    return classes


def _offsets(parts) -> np.ndarray:
    return np.cumsum([0, *map(len, parts)], dtype=np.int64)


def _gather(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts ``ids`` of ``data`` one after another, and their n + 1 bounds."""
    sizes = offsets[ids + 1] - offsets[ids]
    bounds = np.zeros(len(ids) + 1, dtype=np.int64)
    np.cumsum(sizes, out=bounds[1:])
    at = np.repeat(offsets[ids] - bounds[:-1], sizes)
    at += np.arange(bounds[-1])
    return data[at], bounds


class ByteCodec:
    """Encoder and decoder of one rank file; built once in each Python worker."""

    def __init__(self, ranks: Ranks):
        self.rank = {token: i for i, token in enumerate(ranks.tokens)}
        self.classes = ranks.classes
        self.byte_ids = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = sorted((a << 32 | b, i) for token, i in self.rank.items() for k in range(1, len(token))
                       if (a := self.rank.get(token[:k])) is not None
                       and (b := self.rank.get(token[k:])) is not None)
        self.pair_keys = np.array([key for key, _ in pairs] or [-1], dtype=np.int64)
        self.pair_ids = np.array([i for _, i in pairs] or [-1], dtype=np.int32)
        self.bytes = np.frombuffer(b"".join(ranks.tokens), dtype=np.uint8)
        self.byte_offsets = _offsets(ranks.tokens)
        digits = [b" %d" % i for i in range(len(ranks.tokens))]
        self.digits, self.digit_offsets = np.frombuffer(b"".join(digits), dtype=np.uint8), _offsets(digits)
        self.forget()

    def forget(self):
        """Empty the cache of pieces."""
        self.known: dict[str, int] = {}  # piece -> its place in the pool
        self.pool = [np.empty(0, dtype=np.int32)]  # ids of all pieces, batch by batch
        self.pool_sizes = [np.empty(0, dtype=np.int64)]
        self.places = 0
        self.held = 0

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: the adjacent pair of lowest rank merges, leftmost first."""
        whole = self.rank.get(piece)
        return [whole] if whole is not None else self._merge_long(piece)

    def _pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the merged pairs; ``_NONE`` where the vocabulary has no such token."""
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (right >= 0) & (left >= 0),
                        self.pair_ids[at], _NONE)

    def _merge_batch(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of short pieces and the number of each piece's ids: one row per
        piece, in every round the best pair of each row merges."""
        size = np.array([len(p) for p in pieces])
        width = int(size.max())
        parts = np.full((len(pieces), width), -1, dtype=np.int32)
        filled = np.arange(width) < size[:, None]
        parts[filled] = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        ranks = self._pair_rank(parts[:, :-1], parts[:, 1:])
        out, rows = parts.copy(), np.arange(len(pieces))
        columns = np.arange(width)
        while len(rows) and ranks.shape[1]:
            best = ranks.argmin(axis=1)  # the first of equals
            every = np.arange(len(rows))
            lowest = ranks[every, best]
            done = lowest == _NONE
            if done.any():
                out[rows[done]] = parts[done]
                going = ~done
                rows, parts, ranks = rows[going], parts[going], ranks[going]
                best, lowest, every = best[going], lowest[going], np.arange(len(rows))
                if not len(rows):
                    break
            parts[every, best] = lowest
            # what follows the pair moves one place to the left
            source = np.minimum(columns + (columns > best[:, None]), width - 1)
            parts = np.take_along_axis(parts, source, axis=1)
            parts[:, -1] = -1
            ranks = np.take_along_axis(ranks, source[:, :-1].clip(max=width - 2), axis=1)
            ranks[:, -1] = _NONE
            for k in (best - 1, best):
                inside = np.flatnonzero((k >= 0) & (k < width - 1))
                at = k[inside]
                ranks[inside, at] = self._pair_rank(parts[inside, at], parts[inside, at + 1])
        else:
            out[rows] = parts
        kept = out >= 0
        return out[kept], kept.sum(axis=1)

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap of pairs over a linked list: n log n steps."""
        rank, n = self.rank, len(piece)
        end = list(range(1, n + 1))     # of the part that starts at a position
        before = list(range(-1, n - 1))  # start of the part before it
        heap = [(r, k) for k in range(n - 1) if (r := rank.get(piece[k:k + 2])) is not None]
        heapq.heapify(heap)
        current = dict((k, r) for r, k in heap)  # rank of the pair that starts at a position

        def renew(k):
            middle = end[k]
            r = rank.get(piece[k:end[middle]]) if middle < n else None
            if r is None:
                current.pop(k, None)
            else:
                current[k] = r
                heapq.heappush(heap, (r, k))

        while heap:
            r, k = heapq.heappop(heap)
            if current.get(k) != r:
                continue
            middle = end[k]
            current.pop(middle, None)
            end[k] = end[middle]
            if end[k] < n:
                before[end[k]] = k
            renew(k)
            if before[k] >= 0:
                renew(before[k])
        out, k = [], 0
        while k < n:
            out.append(rank[piece[k:end[k]]])
            k = end[k]
        return out

    def _learn(self, pieces: list[str]) -> list[str]:
        """Add pieces to the pool; returns those too long to be remembered."""
        by_width: dict[int, list[int]] = {}
        found: list[list[int] | None] = [None] * len(pieces)
        words = [piece.encode("utf-8", "surrogatepass") for piece in pieces]
        for k, word in enumerate(words):
            whole = self.rank.get(word)
            if whole is not None:
                found[k] = [whole]
            elif len(word) > _SHORT_PIECE:
                found[k] = self._merge_long(word)
            else:
                by_width.setdefault(-(-len(word) // 8), []).append(k)
        order = [k for k, ids in enumerate(found) if ids is not None]
        flat = [np.array([i for k in order for i in found[k]], dtype=np.int32)]
        sizes = [np.array([len(found[k]) for k in order], dtype=np.int64)]
        for group in by_width.values():
            for start in range(0, len(group), _BATCH):
                part = group[start:start + _BATCH]
                ids, size = self._merge_batch([words[k] for k in part])
                flat.append(ids)
                sizes.append(size)
                order += part
        for place, k in enumerate(order, self.places):
            self.known[pieces[k]] = place
        self.places += len(order)
        self.pool = [np.concatenate(self.pool + flat)]
        self.pool_sizes = [np.concatenate(self.pool_sizes + sizes)]
        self.held += sum(map(len, words)) + 200 * len(words) + 4 * sum(map(len, flat))
        return [piece for piece in pieces if len(piece) > CACHE_CHARS]

    def encode_slice(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of ``texts`` and the n + 1 bounds of each text's ids."""
        if self.held > CACHE_BYTES:
            self.forget()
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        cuts = piece_starts(points, ends, self.classes)
        closing = np.searchsorted(cuts, ends)  # separators among the cuts
        at = cuts.tolist()
        # the piece from a separator to the next text is dropped below
        pieces = [joined[a:b] for a, b in zip(at, at[1:] + [len(joined)])]
        missing = set(pieces).difference(self.known)
        passing = self._learn(list(missing)) if missing else []
        places = np.delete(np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces)), closing)
        for piece in passing:
            del self.known[piece]
        pool_ends = np.concatenate([[0], np.cumsum(self.pool_sizes[0])])
        ids, bounds = _gather(self.pool[0], pool_ends, places)
        pieces_before = closing - np.arange(len(closing))  # pieces up to the end of each text
        return ids, np.concatenate([[0], bounds[pieces_before]])

    def encode(self, text: str) -> np.ndarray:
        return np.concatenate([self.encode_slice([part])[0] for part in _parts(text)])

    def decode(self, ids) -> bytes:
        """Bytes of ``ids`` (an id outside the vocabulary is an IndexError)."""
        ids = np.asarray(ids, dtype=np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.rank)):
            raise IndexError("id outside the vocabulary")
        return _gather(self.bytes, self.byte_offsets, ids)[0].tobytes()

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """First byte of every token in its text, in UTF-8."""
        return np.cumsum(self.byte_offsets[ids + 1] - self.byte_offsets[ids]) - (
            self.byte_offsets[ids + 1] - self.byte_offsets[ids])

    def encode_texts(self, texts):
        """Yield (text number, ids) part by part; texts in order, long ones in several parts."""
        held, size = [], 0

        def flush():
            ids, bounds = self.encode_slice([part for _, part in held])
            for k, (number, _) in enumerate(held):
                yield number, ids[bounds[k]:bounds[k + 1]]

        for number, text in enumerate(texts):
            for part in _parts(text):
                if held and size + len(part) > SLICE_CHARS:
                    yield from flush()
                    held, size = [], 0
                held.append((number, part))
                size += len(part) + 1
        if held:
            yield from flush()


def _parts(text: str):
    """A long text in parts that start at a blank between two other characters.

    There a piece starts whatever surrounds it. Without such a blank the text
    stays whole.
    """
    start = 0
    while len(text) - start > LONG_CHARS:
        cut = text.find(" ", start + SLICE_CHARS)
        while cut >= 0 and (cut + 1 >= len(text) or text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


_CODECS: dict[int, ByteCodec] = {}


def _worker_codec(shared) -> ByteCodec:
    """The codec of a broadcast vocabulary, one per worker process."""
    if shared.id not in _CODECS:
        _CODECS.clear()
        _CODECS[shared.id] = ByteCodec(shared.value)
    return _CODECS[shared.id]


class _Shared:
    """A broadcast rank file with an identity that workers can keep a codec under."""

    def __init__(self, df: DataFrame, path: str):
        ranks = load_ranks(path)
        self.value_of = df.sparkSession.sparkContext.broadcast(ranks)
        self.id = hash((path, len(ranks.tokens)))

    @property
    def value(self) -> Ranks:
        return self.value_of.value


def encode(df: DataFrame, ranks_path: str, text_col: str = "text", keep=("doc_id",)) -> DataFrame:
    """The ``keep`` columns, ``n_tokens``, ``ids`` and ``offsets`` (array<int>: the
    first byte of each token in the UTF-8 text).

    A null or empty text has no ids. Repeated rows are kept, other columns are not
    read, a column of ``keep`` with one of the names above is replaced.
    """
    shared = _Shared(df, ranks_path)

    def prepare():
        codec = _worker_codec(shared)

        def compute(texts):
            ids = [[] for _ in texts]
            for number, part in codec.encode_texts([t or "" for t in texts]):
                ids[number].append(part)
            flat = [np.concatenate(parts) if parts else np.empty(0, dtype=np.int32) for parts in ids]
            return [len(i) for i in flat], flat, [codec.offsets(i).astype(np.int32) for i in flat]

        return compute

    return add_columns(df.select(*keep, F.col(text_col).alias("__text")), ["__text"],
                       "n_tokens long, ids array<int>, offsets array<int>", prepare, drop=["__text"])


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """``df`` with ``decoded`` (binary), the bytes of ``ids_col``.

    Null ids decode to null, and so does an array with a null or an id outside the
    vocabulary. No ids decode to no bytes.
    """
    shared = _Shared(df, ranks_path)

    def prepare():
        codec = _worker_codec(shared)

        def one(ids):
            if ids is None or None in ids:
                return None
            try:
                return codec.decode(ids)
            except IndexError:
                return None

        return lambda rows: ([one(ids) for ids in rows],)

    return add_columns(df, [ids_col], "decoded binary", prepare)


def encode_decode(df: DataFrame, ranks_path: str, text_col: str = "text", keep=("doc_id",)) -> DataFrame:
    """Encode every whole text and decode the ids again: the ``keep`` columns,
    ``n_tokens``, ``ids_sha256`` (decimal ids joined by one space) and
    ``decoded_sha256`` (the decoded bytes), made in the worker part by part.

    A null or empty text has no ids and decodes to no bytes. Repeated rows are
    kept, other columns are not read. Rows never shuffle.
    """
    shared = _Shared(df, ranks_path)

    def prepare():
        codec = _worker_codec(shared)

        def compute(texts):
            counts = [0] * len(texts)
            ids_digest = [hashlib.sha256() for _ in texts]
            text_digest = [hashlib.sha256() for _ in texts]
            for number, ids in codec.encode_texts([t or "" for t in texts]):
                digits, _ = _gather(codec.digits, codec.digit_offsets, ids)
                # each id brings the blank before it, but for the first of a text
                ids_digest[number].update(digits[0 if counts[number] else 1:])
                text_digest[number].update(_gather(codec.bytes, codec.byte_offsets, ids)[0])
                counts[number] += len(ids)
            pa.default_memory_pool().release_unused()
            return counts, [d.hexdigest() for d in ids_digest], [d.hexdigest() for d in text_digest]

        return compute

    return add_columns(df.select(*keep, F.col(text_col).alias("__text")), ["__text"],
                       "n_tokens long, ids_sha256 string, decoded_sha256 string", prepare,
                       drop=["__text"])
