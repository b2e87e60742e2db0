r"""Whole-text tokenization with the tokenizers library, piece by piece.

A byte-level BPE tokenizer first cuts a text by the pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+

and then merges inside each part alone. Some places between two characters are
a cut whatever stands around them, if white space comes only as single spaces
and single line feeds between other characters: before a space, on both sides
of a line feed, and between a letter, a digit and any other sign where no
apostrophe comes first. The ids of a text are the ids of the pieces between
such places. Pieces repeat, so each is encoded once and found again by a
64-bit hash, all in arrays; the bytes of a found piece are compared with those
that were encoded, and a text with another piece of that hash is encoded whole. Where white space is not so simple, or a special
token may stand, the text is encoded as a whole.
"""

from __future__ import annotations

import os

import numpy as np

from tessera.llm.hashing import equal_spans, lean, span_hashes

_SPACE, _FEED, _LETTER, _DIGIT, _SIGN, _APOSTROPHE, _HIGH = range(7)


def _classes() -> np.ndarray:
    out = np.full(256, _SIGN, np.uint8)
    out[128:] = _HIGH
    for i in range(128):
        if chr(i).isalpha():
            out[i] = _LETTER
        elif chr(i).isdigit():
            out[i] = _DIGIT
    out[32], out[10], out[39] = _SPACE, _FEED, _APOSTROPHE
    return out


_CLASS = _classes()


def _cut_table() -> np.ndarray:
    """Whether there is a cut between a byte of one class and a byte of another."""
    cut = np.zeros((7, 7), bool)
    cut[:, _SPACE] = cut[:, _FEED] = cut[_FEED, :] = True
    cut[_LETTER, [_DIGIT, _SIGN, _APOSTROPHE]] = True
    cut[_DIGIT, [_LETTER, _SIGN, _APOSTROPHE]] = True
    cut[_SIGN, [_LETTER, _DIGIT]] = True
    return cut.reshape(-1)


_CUT = _cut_table()
#: ASCII white space other than space and line feed.
_RARE = np.zeros(256, bool)
_RARE[[9, 11, 12, 13, 28, 29, 30, 31]] = True


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _odd_places(b: np.ndarray) -> np.ndarray:
    """Positions that forbid cutting: white space side by side, at an end, or of another kind, and '<|'.

    ``b`` holds texts that end with a zero byte, and begins with one.
    """
    space = (b == 32) | (b == 10)
    edge = space | (b == 0)
    found = [np.flatnonzero((space[1:] & edge[:-1]) | (edge[1:] & space[:-1])), np.flatnonzero(_RARE[b]), np.flatnonzero((b[1:] == 124) & (b[:-1] == 60))]
    for lead in (0xC2, 0xE1, 0xE2, 0xE3):
        at = np.flatnonzero(b == lead)
        if not len(at):
            continue
        c, d = b[at + 1], b[np.minimum(at + 2, len(b) - 1)]
        if lead == 0xC2:
            bad = (c == 0x85) | (c == 0xA0)
        elif lead == 0xE1:
            bad = (c == 0x9A) & (d == 0x80)
        elif lead == 0xE2:
            bad = ((c == 0x80) & ((d <= 0x8A) | (d == 0xA8) | (d == 0xA9) | (d == 0xAF))) | ((c == 0x81) & (d == 0x9F))
        else:
            bad = (c == 0x80) & (d == 0x80)
        found.append(at[bad])
    return np.concatenate(found)


class Encoder:
    """Ids of texts as unsigned 32-bit arrays."""

    def __init__(self, path: str, cache_pieces: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        lean()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)  # by id: begins with a space
        self.spaced[[i for t, i in vocabulary.items() if t[0] == "Ġ"]] = True
        self.feed = vocabulary["Ċ"]
        self.cache_pieces = cache_pieces
        self._forget()

    def _forget(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.starts = self.counts = np.empty(0, np.int64)
        self.store, self.used = np.empty(1 << 16, np.uint32), 0
        self.raw, self.raw_used = np.zeros(1 << 16, np.uint8), 0  # the pieces' bytes
        self.raw_starts = self.raw_sizes = np.empty(0, np.int64)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, pieces: list[str], feeds: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of pieces that all begin with a space, or of others, parted by line feeds."""
        ids, counts, at, held = [], [], 0, 0
        texts, sizes = [], []
        for i, p in enumerate(pieces):
            held += len(p) + 1
            if held > 20_000 or i + 1 == len(pieces):
                texts.append(("\n" if feeds else "").join(pieces[at : i + 1]))
                sizes.append(i + 1 - at)
                at, held = i + 1, 0
        for got, n in zip(self._whole(texts), sizes):
            if feeds:
                ends = np.concatenate([np.flatnonzero(got == self.feed), [len(got)]])
                per = np.diff(ends, prepend=-1) - 1
                ids.append(got[got != self.feed])
            else:
                cuts = np.flatnonzero(self.spaced[got])
                per = np.diff(np.concatenate([cuts, [len(got)]]))
                ids.append(got)
            if len(per) != n:
                raise RuntimeError("pieces and ids do not agree")
            counts.append(per)
        return np.concatenate(ids), np.concatenate(counts).astype(np.int64)

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        texts = [p.decode() for p in pieces]
        groups: dict[str, list[int]] = {"space": [], "feed": [], "else": []}
        for i, t in enumerate(texts):
            groups["space" if t[0] == " " else "feed" if t == "\n" else "else"].append(i)
        order, ids, counts = [], [], []
        for kind, at in groups.items():
            if not at:
                continue
            if kind == "feed":
                got, per = np.array([self.feed] * len(at), np.uint32), np.ones(len(at), np.int64)
            else:
                got, per = self._pieces([texts[i] for i in at], kind == "else")
            order += at
            ids.append(got)
            counts.append(per)
        ids, counts, order = np.concatenate(ids), np.concatenate(counts), np.array(order)
        starts = np.cumsum(counts) - counts + self.used
        if self.used + len(ids) > len(self.store):
            self.store = np.concatenate([self.store[: self.used], np.empty(self.used + 2 * len(ids), np.uint32)])
        self.store[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        back = np.argsort(order)
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.starts = np.insert(self.starts, at, starts[back])
        self.counts = np.insert(self.counts, at, counts[back])
        raw, sizes = np.frombuffer(b"".join(pieces), np.uint8), np.array([len(p) for p in pieces], np.int64)
        if self.raw_used + len(raw) + 8 > len(self.raw):
            self.raw = np.concatenate([self.raw[: self.raw_used], np.zeros(self.raw_used + 2 * len(raw) + 8, np.uint8)])
        self.raw[self.raw_used : self.raw_used + len(raw)] = raw
        self.raw_starts = np.insert(self.raw_starts, at, np.cumsum(sizes) - sizes + self.raw_used)
        self.raw_sizes = np.insert(self.raw_sizes, at, sizes)
        self.raw_used += len(raw)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.keys) > self.cache_pieces:
            self._forget()
        raws = [t.encode() for t in texts]
        ends = np.cumsum([len(r) + 1 for r in raws])  # of each text with its zero
        data = b"\0" + b"\0".join(raws) + b"\0"
        b = np.frombuffer(data, np.uint8)
        whole = np.zeros(len(texts), bool)
        whole[np.minimum(np.searchsorted(ends, _odd_places(b), side="left"), len(texts) - 1)] = True
        whole |= np.array([b"\0" in r for r in raws], bool)
        out: list[np.ndarray | None] = [None] * len(texts)
        odd = np.flatnonzero(whole).tolist()
        for i, ids in zip(odd, self._whole([texts[i] for i in odd]) if odd else []):
            out[i] = ids
        even = np.flatnonzero(~whole).tolist()
        if odd:
            data = b"\0" + b"\0".join([raws[i] for i in even]) + b"\0"
            b = np.frombuffer(data, np.uint8)
        if not even or len(b) <= len(even) + 1:
            return [np.empty(0, np.uint32) if x is None else x for x in out]
        kind = _CLASS[b]
        kind[np.flatnonzero(b == 0)] = _FEED  # cuts on both sides
        at = np.flatnonzero(b == 0xC3)  # U+00C0 to U+00FF are letters but for two
        at = at[(b[at + 1] != 0x97) & (b[at + 1] != 0xB7)]
        kind[at] = kind[at + 1] = _LETTER
        pair = kind[:-1] * np.uint8(7) + kind[1:]
        cut = _CUT[pair]
        cut &= (b[:-1] != 32) | (b[1:] == 0)  # a space stays with what follows
        starts = np.flatnonzero(cut) + 1
        stops = np.append(starts[1:], len(b))
        real = b[starts] != 0
        starts, stops = starts[real], stops[real]
        padded = data + b"\0" * 8
        hashes = span_hashes(padded, starts, stops)
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        where = np.searchsorted(self.keys, unique)
        known = self.keys[np.minimum(where, len(self.keys) - 1)] == unique if len(self.keys) else np.zeros(len(unique), bool)
        if not known.all():
            new = np.flatnonzero(~known)
            self._learn(unique[new], [data[x:y] for x, y in zip(starts[first[new]].tolist(), stops[first[new]].tolist())])
            where = np.searchsorted(self.keys, unique)
        found = where[back]
        differ = ~equal_spans(padded, starts, stops - starts, self.raw, self.raw_starts[found], self.raw_sizes[found])
        per = self.counts[where][back]
        upto = np.cumsum(per)
        ids = self.store[np.arange(upto[-1]) + np.repeat(self.starts[where][back] - (upto - per), per)]
        zeros = np.flatnonzero(b == 0)
        bounds = np.concatenate([[0], upto])[np.searchsorted(starts, zeros)]
        for k, i in enumerate(even):
            out[i] = ids[bounds[k] : bounds[k + 1]]
        if differ.any():
            for k in set((np.searchsorted(zeros, starts[differ]) - 1).tolist()):
                out[even[k]] = self._whole([texts[even[k]]])[0]
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def text_slices(texts, chars: int = 1_000_000, rows: int = 4096):
    """(first row, list of texts) of an Arrow string column, parts of about so many bytes and at most so many rows."""
    import pyarrow.compute as pc

    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and (held + n > chars or i - start == rows):
            yield start, texts.slice(start, i - start).to_pylist()
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, texts.slice(start).to_pylist()
