"""Blocking, cap, score and top k of one tile: some source-1 records against all records of their country.

The rows of a tile come in order: source-1 records first, then the pool by id,
which is read in sections. What is held is the records of one section and the
best ``max_candidates`` of each source-1 name, so that no table of pairs exists
before the last cut. Without a cap every pair is scored in its section, and the
best ``k`` of each name are held.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa

#: Pool records looked at together.
SECTION = 50_000
#: Rows of a batch that goes out.
OUT = 50_000
_SPACE = re.compile(r"[ \t\n\x0b\f\r]+")
_MICRO = Decimal("0.000001")


def blocking_words(name: str, min_len: int) -> list[str]:
    """As :func:`tessera.functions.tokens.blocking_tokens`."""
    return list(dict.fromkeys(w for w in _SPACE.split(name) if len(w) >= min_len and w))


def micros(x: np.ndarray) -> np.ndarray:
    """Millionths, rounded half up by the shortest decimal form, as Spark does."""
    y = x * 1e6
    out = np.floor(y + 0.5).astype(np.int64)
    for i in np.flatnonzero(np.abs(y - np.floor(y) - 0.5) < 1e-3):
        out[i] = int(Decimal(repr(float(x[i]))).quantize(_MICRO, ROUND_HALF_UP).scaleb(6))
    return out


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of several runs, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class Grams:
    """Numbers for the n-grams of words padded by a space; a word is cut once."""

    def __init__(self, space: re.Pattern | None = None) -> None:
        self.space = space
        self.ids: dict[str, int] = {}
        self.words: dict[str, np.ndarray] = {}

    def of_word(self, word: str) -> np.ndarray:
        w, ids = f" {word} ", self.ids
        got = np.array([ids.setdefault(w[i : i + n], len(ids)) for n in (2, 3, 4) for i in range(len(w) - n + 1)], np.int64)
        self.words[word] = got
        return got

    def of_names(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The grams of all names, repeats kept, and how many each has."""
        words = [n.lower().split() if self.space is None else [w for w in self.space.split(n.lower()) if w] for n in names]
        known = self.words
        parts = [known[w] if w in known else self.of_word(w) for ws in words for w in ws]
        lengths = np.zeros(len(names), np.int64)
        if parts:
            np.add.at(lengths, np.repeat(np.arange(len(names)), [len(ws) for ws in words]), np.array([len(x) for x in parts], np.int64))
        return np.concatenate(parts) if parts else np.zeros(0, np.int64), lengths

    def counted(self, names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, gram and count of every distinct gram of every name, by row, and the counts' norms."""
        flat, lengths = self.of_names(names)
        width = max(len(self.ids), 1)
        at, n = np.unique(np.repeat(np.arange(len(names)), lengths) * width + flat, return_counts=True)
        row = at // width
        return row, at % width, n, np.sqrt(np.bincount(row, (n * n).astype(float), len(names)))


class Tile:
    def __init__(self, min_len: int, most: int | None, k: int | None = None, floor: float = 0.0) -> None:
        self.min_len, self.most, self.k, self.floor = min_len, most, k, floor
        self.mine: list[pa.Array] = []
        self.mine_names: list[str] = []
        self.ids: list[pa.Array] = []
        self.seen, self.waiting, self.started = 0, [], False

    def add(self, kind: int, rows: pa.RecordBatch) -> None:
        if kind == 0:
            self.mine.append(rows["entity_id"])
            self.mine_names += rows["name"].to_pylist()
            return
        self.waiting.append(rows)
        if sum(len(x) for x in self.waiting) >= SECTION:
            self.look()

    def start(self) -> None:
        """The distinct names of source 1, their tokens and grams."""
        self.started = True
        places: dict[str, int] = {}
        self.name_of = np.array([places.setdefault(n, len(places)) for n in self.mine_names], np.int64)
        self.names = list(places)
        self.tokens: dict[str, int] = {}
        self.wanted = [[self.tokens.setdefault(w, len(self.tokens)) for w in blocking_words(n, self.min_len)] for n in self.names]
        self.grams = Grams()
        row, self.gram, self.times, self.norm = self.grams.counted(self.names)
        self.bound = np.searchsorted(row, np.arange(len(self.names) + 1))
        # The best so far of each name: key (fewer shared tokens, then commoner ones, are larger), place in the pool, score
        # (in millionths where there is no cap, best first).
        self.keys: list[np.ndarray | None] = [None] * len(self.names)
        self.place: list[np.ndarray | None] = [None] * len(self.names)
        self.score: list[np.ndarray | None] = [None] * len(self.names)

    def look(self) -> None:
        """Meet the waiting records of the pool."""
        if not self.waiting:
            return
        if not self.started:
            self.start()
        rows = pa.Table.from_batches(self.waiting).combine_chunks()
        self.waiting = []
        first, self.seen = self.seen, self.seen + len(rows)
        self.ids.append(rows["entity_id"].combine_chunks())
        if self.most is None:
            self.meet_all(rows, first)
            return
        coded = rows["name"].combine_chunks().dictionary_encode()
        names, name_of = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        cut = [[self.tokens.get(w, -1) for w in blocking_words(n, self.min_len)] for n in names]
        starts = np.cumsum([0] + [len(x) for x in cut])[:-1]
        flat = np.array([t for x in cut for t in x], np.int64)
        at = rows["at"].combine_chunks()
        who = np.repeat(np.arange(len(rows)), at.value_lengths().to_numpy(zero_copy_only=False))
        token = flat[starts[name_of[who]] + at.flatten().to_numpy(zero_copy_only=False)] if len(who) else flat
        df = rows["dfs"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        kept = token >= 0
        who, token, df = who[kept], token[kept], df[kept]
        order = np.argsort(token, kind="stable")
        who, token, df = who[order], token[order], df[order]
        begin = np.searchsorted(token, np.arange(len(self.tokens) + 1))
        occ, length = self.grams.of_names(names)
        _, _, _, norm = self.grams.counted(names)
        offset = np.cumsum(length) - length
        shared, rarest = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        weight = np.zeros(max(len(self.grams.ids), 1))
        for i, wanted in enumerate(self.wanted):
            lists = sorted(((int(df[begin[t]]), begin[t], begin[t + 1]) for t in wanted if begin[t] < begin[t + 1]), reverse=True)
            if not lists:
                continue
            for n, lo, hi in lists:  # the rarest last
                x = who[lo:hi]
                shared[x] += 1
                rarest[x] = n
            hit = np.flatnonzero(shared)
            keys = ((1 << 30) - shared[hit] << 32) + rarest[hit]
            shared[hit] = 0
            old = self.keys[i]
            if old is not None and len(old) == self.most:
                better = keys < old[-1]
                hit, keys = hit[better], keys[better]
            if len(keys) > self.most:
                near = keys <= np.partition(keys, self.most - 1)[self.most - 1]
                hit, keys = hit[near], keys[near]
            if not len(hit):
                continue
            had = 0 if old is None else len(old)
            every = keys if old is None else np.concatenate([old, keys])
            best = np.argsort(every, kind="stable")[: self.most]
            fresh = best >= had
            new = hit[best[fresh] - had]
            lo, hi = self.bound[i], self.bound[i + 1]
            weight[self.gram[lo:hi]] = self.times[lo:hi]
            score, place = np.zeros(len(best)), np.zeros(len(best), np.int64)
            score[fresh] = self.cosines(weight, self.norm[i], name_of[new], occ, offset, length, norm)
            weight[self.gram[lo:hi]] = 0.0
            place[fresh] = first + new
            if had:
                score[~fresh], place[~fresh] = self.score[i][best[~fresh]], self.place[i][best[~fresh]]
            self.keys[i], self.place[i], self.score[i] = every[best], place.astype(np.int32), score

    def meet_all(self, rows: pa.Table, first: int) -> None:
        """Score every pair of a section. Records of one name have the same tokens and scores, so that names meet names."""
        coded = rows["name"].combine_chunks().dictionary_encode()
        names, name_of = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        by_name = np.argsort(name_of, kind="stable")  # places in order inside a name
        begin_of = np.searchsorted(name_of[by_name], np.arange(len(names) + 1))
        count_of = np.diff(begin_of)
        if self.k is not None:
            count_of = np.minimum(count_of, self.k)
        at = rows["at"].combine_chunks().take(pa.array(by_name[begin_of[:-1]]))
        who = np.repeat(np.arange(len(names)), at.value_lengths().to_numpy(zero_copy_only=False))
        cut = [[self.tokens.get(w, -1) for w in blocking_words(n, self.min_len)] for n in names]
        starts = np.cumsum([0] + [len(x) for x in cut])[:-1]
        token = np.array([t for x in cut for t in x], np.int64)[starts[who] + at.flatten().to_numpy(zero_copy_only=False)]
        who, token = who[token >= 0], token[token >= 0]
        order = np.argsort(token, kind="stable")
        who, token = who[order], token[order]
        begin = np.searchsorted(token, np.arange(len(self.tokens) + 1))
        _, _, _, norm = self.grams.counted(names)
        # A name's dot product is the sum of those of its words.
        place_of: dict[str, int] = {}
        words = [[place_of.setdefault(w, len(place_of)) for w in n.lower().split()] for n in names]
        n_words = np.array([len(x) for x in words], np.int64)
        word, word_at = np.array([w for x in words for w in x], np.int64), np.cumsum(n_words) - n_words
        size = np.array([len(self.grams.words[w]) for w in place_of], np.int64)
        occ = np.concatenate([self.grams.words[w] for w in place_of]) if place_of else np.zeros(0, np.int64)
        occ_at = np.cumsum(size) - size
        weight, met = np.zeros(len(self.grams.ids) + 1), np.zeros(len(names), bool)
        for i, wanted in enumerate(self.wanted):
            for t in wanted:
                met[who[begin[t] : begin[t + 1]]] = True
            hit = np.flatnonzero(met)
            if not len(hit):
                continue
            met[hit] = False
            score = np.zeros(len(hit))
            some = n_words[hit] > 0
            if self.norm[i] and some.any():
                lo, hi = self.bound[i], self.bound[i + 1]
                weight[self.gram[lo:hi]] = self.times[lo:hi]
                looked = hit[some]
                flat = word[runs(word_at[looked], n_words[looked])]
                if len(flat) < len(size):  # few words are met of many
                    used, back = np.unique(flat, return_inverse=True)
                    dot = np.add.reduceat(weight[occ[runs(occ_at[used], size[used])]], np.cumsum(size[used]) - size[used])[back]
                else:
                    dot = np.add.reduceat(weight[occ], occ_at)[flat]
                weight[self.gram[lo:hi]] = 0.0
                score[some] = np.add.reduceat(dot, np.cumsum(n_words[looked]) - n_words[looked]) / (self.norm[i] * norm[looked])
            if self.k is not None:
                least = self.floor
                if self.score[i] is not None and len(self.score[i]) == self.k:
                    least = max(least, self.score[i][-1] / 1e6)
                hit, score = hit[score >= least - 1e-6], score[score >= least - 1e-6]
                if len(hit) > self.k:
                    near = score >= np.partition(score, len(score) - self.k)[len(score) - self.k] - 1e-6
                    hit, score = hit[near], score[near]
            m = micros(score)
            if self.k is not None:
                hit, m = hit[m / 1e6 >= self.floor], m[m / 1e6 >= self.floor]
            if not len(hit):
                continue
            place = first + by_name[runs(begin_of[hit], count_of[hit])]
            m = np.repeat(m, count_of[hit])
            if self.place[i] is not None:
                place, m = np.concatenate([self.place[i], place]), np.concatenate([self.score[i], m])
            best = np.lexsort((place, -m))[: self.k]
            self.place[i], self.score[i] = place[best].astype(np.int32), m[best]

    @staticmethod
    def cosines(weight, norm_a, names, occ, offset, length, norm) -> np.ndarray:
        n = length[names]
        out = np.zeros(len(names))
        some = n > 0
        if norm_a and some.any():
            at = occ[runs(offset[names[some]], n[some])]
            dots = np.add.reduceat(weight[at], np.cumsum(n[some]) - n[some])
            out[some] = dots / (norm_a * norm[names[some]])
        return out

    def rows(self, k: int | None, floor: float) -> Iterator[pa.RecordBatch]:
        """(source1_entity_id, candidate_entity_id, blocking_score); all of the best if ``k`` is None."""
        self.look()
        if not self.started or not self.mine:
            return
        ids, mine = pa.concat_arrays(self.ids), pa.concat_arrays(self.mine)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for place, score in zip(self.place, self.score):
            if place is None:
                found.append((np.zeros(0, np.int32), np.zeros(0)))
                continue
            m = micros(score) if self.most is not None else score
            if k is not None and self.most is not None:
                good = np.flatnonzero(m / 1e6 >= floor)
                good = good[np.lexsort((place[good], -m[good]))][:k]
                place, m = place[good], m[good]
            found.append((place, m / 1e6))
        group, n = [], 0
        for i, name in enumerate(self.name_of):
            group.append(i)
            n += len(found[name][0])
            if n >= OUT or i == len(self.name_of) - 1:
                names = self.name_of[group]
                left = np.repeat(np.array(group), [len(found[x][0]) for x in names])
                right = np.concatenate([found[x][0] for x in names])
                scores = np.concatenate([found[x][1] for x in names])
                yield pa.RecordBatch.from_arrays([mine.take(pa.array(left)), ids.take(pa.array(right)), pa.array(scores)], ["source1_entity_id", "candidate_entity_id", "blocking_score"])
                group, n = [], 0


def best(batches: Iterator[pa.RecordBatch], min_len: int, most: int | None, k: int | None, floor: float) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by tile, kind and id, the candidates of each tile's source-1 records."""
    tile, now = None, None
    for batch in batches:
        if not len(batch):
            continue
        keys, kinds = batch["tile"].to_numpy(zero_copy_only=False), batch["kind"].to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (kinds[1:] != kinds[:-1])) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(batch)]):
            if tile is None or keys[lo] != now:
                if tile is not None:
                    yield from tile.rows(k, floor)
                tile, now = Tile(min_len, most, k, floor), keys[lo]
            tile.add(int(kinds[lo]), batch.slice(lo, hi - lo))
    if tile is not None:
        yield from tile.rows(k, floor)
