"""Byte-level BPE over many texts: texts are cut vectorised, and each distinct piece is encoded once.

The cut follows the public pattern of byte-level tokenizers,
's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+ , after which pieces
are independent of each other. Texts with characters whose class differs between the first and the
last Unicode version at hand go to the library whole, and so do texts that hold an added token,
where those count. New pieces are encoded by the library many at a time, in texts that are cut at
those pieces again; the byte lengths of the ids tell where each ends.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np

from folioforge.llm import textkit as tk

LETTER, NUMBER, SPACE, OTHER, UNSURE = range(5)
#: Pieces whose ids are kept from batch to batch; beyond it, the half that is used least is dropped.
CACHED_PIECES = 800_000
#: Pieces that the library gets in one text.
JOINED_PIECES = 1000
#: Code points from here on are unsure.
PLANES_END = 0x30000


def _classes() -> np.ndarray:
    out = np.full(0x110000, UNSURE, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    before = unicodedata.ucd_3_2_0
    for cp in range(PLANES_END):
        kind = unicodedata.category(chr(cp))
        if kind not in ("Cn", "Co", "Cs") and (cp < 0x2000 or before.category(chr(cp)) == kind):
            out[cp] = kinds.get(kind[0], OTHER)
    spaces = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    out[spaces] = SPACE
    return out


def cut(points: np.ndarray, offsets: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Starts of all pieces. offsets: of texts among the code points (texts + 1)."""
    n = len(points)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    edge = np.ones(n + 1, bool)
    edge[1:n] = (cls[1:] != cls[:-1]) | first[1:n]
    start = edge.copy()
    ends = np.flatnonzero(edge[1:] & (cls == SPACE)) + 1  # of runs of white space
    ends = ends[~first[ends] & (ends < n)]
    start[ends - 1] = True
    start[ends[points[ends - 1] == 32]] = False
    marks = np.flatnonzero((points == 39) & start[:n] & edge[:n] & edge[1:])
    marks = marks[(marks + 1 < n)]
    marks = marks[~first[marks + 1] & (cls[marks + 1] == LETTER)]
    if len(marks):
        one = points[marks + 1]
        has_two = (marks + 2 < n) & ~first[np.minimum(marks + 2, n)] & (cls[np.minimum(marks + 2, n - 1)] == LETTER)
        two = np.where(has_two, points[np.minimum(marks + 2, n - 1)], 0)
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        length = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, np.where(pair, 2, 0))
        marks, length = marks[length > 0], length[length > 0]
        start[marks + 1] = False
        after = marks + 1 + length
        inside = (after < n) & ~first[np.minimum(after, n)]
        start[after[inside]] = True
    return np.flatnonzero(start[:n])


class Encoder:
    """Encodes texts with a file of the tokenizers library."""

    def __init__(self, path: str, special_in_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special_in_text
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()] if special_in_text else []
        self.classes = _classes()
        vocabulary = self.tokenizer.get_vocab()
        self.length = np.zeros(max(vocabulary.values()) + 1, np.int64)  # a token is spelt with one character a byte
        self.length[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.hash, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # known pieces, by hash, and their rows in the tables below
        self.flat = np.zeros(0, np.uint32)
        self.at = self.size = self.uses = np.zeros(0, np.int64)

    def _ids_of(self, pieces: list[bytes], between: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of all pieces end to end, and how many each has; None where the ids' lengths do not show the ends."""
        got = np.array(self.tokenizer.encode_batch_fast([between.join(pieces).decode()], add_special_tokens=False)[0].ids, np.int64)
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) + len(between)) - len(between)  # in bytes
        reach = np.cumsum(self.length[got])
        last = np.searchsorted(reach, ends)
        if last[-1] != len(got) - 1 or not np.array_equal(reach[last], ends):
            return None
        size = np.diff(last, prepend=-1)
        if between:
            separators = last[:-1] + 1
            if not (self.length[got[separators]] == len(between)).all():
                return None
            got, size[1:] = np.delete(got, separators), size[1:] - 1
        return got.astype(np.uint32), size

    def _forget(self) -> None:
        """Keeps the half of the pieces that were used in most batches."""
        keep = np.sort(np.argsort(-self.uses[self.slot], kind="stable")[: CACHED_PIECES // 2])
        self.hash, old = self.hash[keep], self.slot[keep]
        at, self.size, self.uses = self.at[old], self.size[old], self.uses[old] // 2
        self.at = np.cumsum(self.size) - self.size
        self.flat = self.flat[np.arange(int(self.size.sum())) + np.repeat(at - self.at, self.size)]
        self.slot = np.arange(len(keep))

    def _learn(self, hashes: np.ndarray, pieces: list[bytes], spaced: np.ndarray, bare: np.ndarray) -> None:
        """spaced: pieces of one space and a run of other characters; bare: those without white space. Either kind is cut at
        its pieces again when the library gets many in one text, the bare ones with line feeds between them.
        """
        order, ids, sizes, alone = [], [], [], [np.flatnonzero(~spaced & ~bare)]
        for own, between in ((np.flatnonzero(spaced), b""), (np.flatnonzero(bare), b"\n")):
            for s in range(0, len(own), JOINED_PIECES):
                part = own[s : s + JOINED_PIECES]
                if (got := self._ids_of([pieces[k] for k in part.tolist()], between)) is None:
                    alone.append(part)
                    continue
                order.append(part)
                ids.append(got[0])
                sizes.append(got[1])
        rest = np.concatenate(alone)
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast([pieces[k].decode() for k in rest.tolist()], add_special_tokens=False)]
        order.append(rest)
        ids.append(np.array([i for x in encoded for i in x], np.uint32))
        sizes.append(np.array([len(x) for x in encoded], np.int64))
        size = np.concatenate(sizes)
        slot = len(self.size) + np.arange(len(hashes))
        self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.uses = np.concatenate([self.uses, np.zeros(len(size), np.int64)])
        self.flat = np.concatenate([self.flat, *ids])
        every = np.concatenate([self.hash, hashes[np.concatenate(order)]])
        sort = np.argsort(every, kind="stable")
        self.hash, self.slot = every[sort], np.concatenate([self.slot, slot])[sort]

    def _slots(self, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of pieces, and which are known. distinct: sorted hashes."""
        if not len(self.hash):
            return np.zeros(len(distinct), np.int64), np.zeros(len(distinct), bool)
        at = np.minimum(np.searchsorted(self.hash, distinct), len(self.hash) - 1)
        return self.slot[at], self.hash[at] == distinct

    def _with_special(self, raw: bytes, offsets: np.ndarray) -> list[int]:
        """Texts that hold an added token."""
        out = []
        for token in self.special:
            at = raw.find(token)
            while at >= 0:
                i = int(np.searchsorted(offsets, at, side="right")) - 1
                inside = at + len(token) <= offsets[i + 1]
                if inside:
                    out.append(i)
                at = raw.find(token, int(offsets[i + 1]) if inside else at + 1)
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each text."""
        heads = (data & 0xC0) != 0x80
        byte_of = np.append(np.flatnonzero(heads), len(data))
        char_offsets = np.concatenate([[0], np.cumsum(heads)])[offsets]
        raw = data.tobytes()
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        cls = self.classes[points]
        whole = np.zeros(len(offsets) - 1, bool)
        unsure = np.flatnonzero(cls == UNSURE)
        whole[np.searchsorted(char_offsets, unsure, side="right") - 1] = True
        whole[self._with_special(raw, offsets)] = True
        start = cut(points, char_offsets, cls)
        doc = np.searchsorted(char_offsets, start, side="right") - 1
        easy = ~whole[doc]
        stop = np.append(start[1:], len(points))[easy]
        start, doc = start[easy], doc[easy]
        bare = cls[start] != SPACE
        spaced = (points[start] == 32) & (stop > start + 1) & (cls[np.minimum(start + 1, len(cls) - 1)] != SPACE)
        start, end = byte_of[start], byte_of[stop]
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(whole)
        if len(start):
            distinct, first, back = np.unique(tk.span_hashes(data, start, end), return_index=True, return_inverse=True)
            if len(self.hash) > CACHED_PIECES:
                self._forget()
            slot, known = self._slots(distinct)
            if not known.all():
                new = np.flatnonzero(~known)
                self._learn(distinct[new], [raw[start[first[k]] : end[first[k]]] for k in new.tolist()], spaced[first[new]], bare[first[new]])
                slot, _ = self._slots(distinct)
            self.uses[slot] += 1
            place = slot[back]
            sizes = self.size[place]
            before = np.cumsum(sizes) - sizes
            ids = self.flat[np.arange(int(sizes.sum())) + np.repeat(self.at[place] - before, sizes)]
            ends = np.searchsorted(doc, np.arange(len(whole)), side="right")
            bounds = np.concatenate([[0], np.append(before, len(ids))[ends]])
            out = [ids[bounds[i] : bounds[i + 1]] for i in range(len(whole))]
        for i in np.flatnonzero(whole).tolist():
            out[i] = np.array(self.tokenizer.encode(data[offsets[i] : offsets[i + 1]].tobytes().decode(), add_special_tokens=False).ids, np.uint32)
        return out


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, special_in_text: bool = False) -> Encoder:
    """One for each Python worker."""
    key = (path, special_in_text)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, special_in_text)
    return _ENCODERS[key]
