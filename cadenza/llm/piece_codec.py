"""Exact encoding and decoding with a merge-type (BPE) sentencepiece vocabulary.

Merging pairs by score gives one token sequence per text, and a sequence is
that one exactly if every two neighbours stay apart when their joined text is
merged again. The encoder therefore walks the text once: an Aho-Corasick
automaton gives the longest piece at each position, a piece is accepted if it
is compatible with the piece before it, and otherwise the next shorter piece is
tried. When none fits, the last piece is taken back and the position is marked
in a bitfield of failed positions, so no position is tried twice.

No piece of a supported vocabulary holds a space mark after another character
or a character outside its own alphabet (checked when the vocabulary is read).
Texts are therefore cut before runs of spaces, around line ends and between
letters and marks that share no piece, without any effect on the result, and the
ids of short cuts are remembered per worker, up to a bound in bytes.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import add_columns

MARK = "▁"
CACHE_BYTES = 32 << 20  # remembered cuts of a Python worker, in each of two generations
ENTRY_BYTES = 210  # of a remembered cut beside its characters: two strings, a dictionary slot
CACHE_CHARS = 48  # longer cuts are encoded each time
PAIR_ENTRIES = 100_000  # about 200 bytes each
TEXT_BYTES = 1 << 20  # of texts encoded at once


class Vocabulary:
    """Pieces, scores and byte ids read from a model file (small, fixed size)."""

    def __init__(self, pieces, scores, normal, byte_ids, end_id):
        self.pieces, self.scores = pieces, scores
        self.normal, self.byte_ids, self.end_id = normal, byte_ids, end_id
        self.key = hashlib.sha256("\x00".join(pieces).encode()).hexdigest()

    @classmethod
    def load(cls, model_path: str) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        normal = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
                  for i in range(size)]
        byte_ids = {int(pieces[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
        vocabulary = cls(pieces, [sp.get_score(i) for i in range(size)], normal, byte_ids,
                         sp.eos_id())
        own = [p for p, n in zip(pieces, normal) if n]
        alphabet = {p for p in own if len(p) == 1}
        if len(byte_ids) != 256 or vocabulary.end_id < 0:
            raise ValueError("the vocabulary needs byte pieces and an end id")
        if any(MARK in p.lstrip(MARK) or not alphabet.issuperset(p) for p in own):
            raise ValueError("pieces must start with their space marks and use their own alphabet")
        if sp.encode("a b", out_type=str)[0][:1] != MARK:
            raise ValueError("the model must add a leading space mark")
        return vocabulary


class Codec:
    """Encoder and decoder of one vocabulary; built once in each Python worker."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.v = vocabulary
        self.pieces = vocabulary.pieces
        self.ids = {p: i for i, (p, n) in enumerate(zip(self.pieces, vocabulary.normal)) if n}
        self.alphabet = {p for p in self.ids if len(p) == 1}
        self.byte_values = {i: b for b, i in vocabulary.byte_ids.items()}
        reachable = {p: i for p, i in self.ids.items() if self.merge(p) == [i]}
        self.automaton = ahocorasick.Automaton()
        for piece, i in reachable.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.shorter = {}  # piece id -> the next shorter piece that starts it
        for piece, i in reachable.items():
            cut = next((piece[:n] for n in range(len(piece) - 1, 0, -1) if piece[:n] in reachable), None)
            self.shorter[i] = reachable[cut] if cut else None
        # characters that share no piece, even by way of others, with the letters:
        # a cut between them and the rest is safe
        touching: dict[str, set[str]] = {}
        for p in self.ids:
            for a, b in zip(p, p[1:]):
                if a != MARK:
                    touching.setdefault(a, set()).add(b)
                    touching.setdefault(b, set()).add(a)
        rest, grow = set(), {c for c in self.alphabet if c.isascii() and c.isalpha()}
        while grow:
            rest |= grow
            grow = {b for a in grow for b in touching.get(a, ())} - rest
        apart = {chr(n) for n in range(33, 127)} - rest
        while more := {b for a in apart for b in touching.get(a, ())} - apart:
            apart |= more
        breaks = "".join(c for c in "\n\r\t" if c not in self.alphabet)
        own = "".join(map(re.escape, sorted(apart)))
        rules = [f" +(?:[{own}]+|[^ {breaks}{own}]*)", f"[{own}]+"] if own else [f" +[^ {breaks}]*"]
        rules += [f"[^ {breaks}{own}]+"] + ([f"[{breaks}]"] if breaks else [])
        self.cuts = re.compile("|".join(rules))
        self.changed: dict[str, str] = {}  # cuts of the current text that decode to another text
        self.forget()

    def forget(self):
        """Drop all that was remembered."""
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.known_bytes = 0

    def merge(self, text: str) -> list[int]:
        """Ids of a short text by merging its best-scored pair again and again."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.v.scores[i] > best):
                    best, at = self.v.scores[i], k
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        got = self.pairs.get((left, right))
        if got is None:
            if len(self.pairs) >= PAIR_ENTRIES:
                self.pairs.clear()
            got = self.merge(self.pieces[left] + self.pieces[right]) == [left, right]
            self.pairs[left, right] = got
        return got

    def encode_run(self, run: str) -> list[int]:
        """Ids of a run of characters of the alphabet, by backtracking."""
        size = len(run)
        # every character is a piece, so the leftmost longest match starts at its argument
        longest, pieces, shorter = self.automaton.iter_long, self.pieces, self.shorter
        failed = bytearray(size // 8 + 1)  # bit n: no sequence goes on from position n
        out: list[int] = []
        at, candidate = 0, next(longest(run))[1]
        while at < size:
            last = out[-1] if out else None
            while candidate is not None:
                end = at + len(pieces[candidate])
                if not failed[end >> 3] >> (end & 7) & 1 and (
                        last is None or self.compatible(last, candidate)):
                    break
                candidate = shorter[candidate]
            if candidate is not None:
                out.append(candidate)
                at = end
                candidate = next(longest(run, at))[1] if at < size else None
            else:
                failed[at >> 3] |= 1 << (at & 7)
                taken = out.pop()  # position 0 always has a solution
                at -= len(pieces[taken])
                candidate = shorter[taken]
        return out

    def encode_cut(self, cut: str) -> list[int]:
        cut = cut.replace(" ", MARK)
        if self.alphabet.issuperset(cut):
            return self.encode_run(cut)
        out: list[int] = []
        start = 0
        for k, c in enumerate(cut):
            if c not in self.alphabet:
                if k > start:
                    out += self.encode_run(cut[start:k])
                out += [self.v.byte_ids[b] for b in c.encode("utf-8", "surrogatepass")]
                start = k + 1
        if start < len(cut):
            out += self.encode_run(cut[start:])
        return out

    def cuts_of(self, text: str) -> list[str]:
        return self.cuts.findall(" " + text.replace(MARK, " ")) if text else []

    def encode(self, text: str) -> list[int]:
        """All ids of ``text``, the end id included."""
        return [i for cut in self.cuts_of(text) for i in self.encode_cut(cut)] + [self.v.end_id]

    def _pieces_text(self, ids: list[int]) -> str:
        out, held = [], bytearray()
        for i in ids:
            if i in self.byte_values:
                held.append(self.byte_values[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held = bytearray()
            if self.v.normal[i]:
                out.append(self.pieces[i].replace(MARK, " "))
        if held:
            out.append(held.decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """Text of ``ids``: marks become spaces, the added leading one goes."""
        text = self._pieces_text(ids)
        return text[1:] if text[:1] == " " else text

    def _learn(self, cut: str) -> str:
        got = self.older.get(cut)
        if got is None:
            ids = self.encode_cut(cut)
            got = " ".join(map(str, ids))
            text = self._pieces_text(ids)
            if text != cut:
                self.changed[cut] = text
                return got
        if len(cut) <= CACHE_CHARS:
            self.known_bytes += ENTRY_BYTES + len(cut) + len(got)
            if self.known_bytes > CACHE_BYTES:
                self.known, self.older, self.known_bytes = {}, self.known, 0
            self.known[cut] = got
        return got

    def round_trip(self, text: str) -> tuple[str, str]:
        """Decimal ids joined by spaces (end id included) and the decoded text.

        A remembered cut is one whose ids were decoded to the cut itself.
        """
        if not text:
            return str(self.v.end_id), ""
        self.changed = {}
        cuts = self.cuts_of(text)
        ids = " ".join([self.known.get(cut) or self._learn(cut) for cut in cuts])
        changed = self.changed
        text = "".join([changed.get(cut, cut) for cut in cuts] if changed else cuts)
        return f"{ids} {self.v.end_id}", text[1:] if text[:1] == " " else text


_CODECS: dict[str, Codec] = {}


def _codec(vocabulary: Vocabulary) -> Codec:
    if vocabulary.key not in _CODECS:
        _CODECS[vocabulary.key] = Codec(vocabulary)
    return _CODECS[vocabulary.key]


@lru_cache(maxsize=4)
def _vocabulary(model_path: str) -> Vocabulary:
    return Vocabulary.load(model_path)


def encode_decode(df: DataFrame, model_path: str, text_col: str = "text", keep=("doc_id",),
                  with_text: bool = False, with_ids: bool = False) -> DataFrame:
    """Encode and decode ``text_col`` of every row with the model at ``model_path``.

    Returns the ``keep`` columns and ``n_tokens`` (all ids, end id included),
    ``ids`` (decimal, joined by one space) and ``decoded``; without ``with_text``
    the last two are replaced by their SHA-256 digests ``ids_sha256`` and
    ``decoded_sha256``, made in the worker so that neither leaves it; ``with_ids`` adds the ids beside
    the digests, as numbers (``ids``, array<int>). A null or
    empty text has the end id alone and decodes to the empty text. Repeated rows
    are kept; other columns are not read. The vocabulary (a fixed file) is sent
    to the workers once; rows never shuffle.
    """
    shared = df.sparkSession.sparkContext.broadcast(_vocabulary(model_path))
    fields = ("n_tokens long, ids string, decoded string" if with_text
              else "n_tokens long, ids_sha256 string, decoded_sha256 string")
    if with_ids and not with_text:
        fields += ", ids array<int>"

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def prepare():
        codec = _codec(shared.value)

        def compute(texts):
            both = [codec.round_trip(t or "") for t in texts]
            out = both if with_text else [(digest(ids), digest(text)) for ids, text in both]
            made = ([ids.count(" ") + 1 for ids, _ in both],
                    [ids for ids, _ in out], [text for _, text in out])
            if with_ids and not with_text:
                made += ([np.fromstring(ids, dtype=np.int32, sep=" ") for ids, _ in both],)
            return made

        return compute

    return add_columns(df.select(*keep, F.col(text_col).alias("__text")), ["__text"], fields,
                       prepare, drop=["__text"], size=TEXT_BYTES)
