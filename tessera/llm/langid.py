"""Language identification with string kernels.

Two texts are compared by the blended spectrum kernel over presence: the
number of character n-grams of 1 to ``MAX_N`` letters that both hold, over the
root of the product of how many each holds. The kernel is approximated by the
Nystroem method: a text is known by its kernel with a few landmark texts of
each language. On these, one kernel ridge regression a language tells it from
the rest. Texts are scored in batches: a matrix of n-gram presence times that
of the landmarks, times the weights.

N-grams are hashed to ``DIM`` places. The model is fitted on at most
``SAMPLE`` labelled texts of each language, whole texts chosen by a hash of
their ids; only their presence bits, DIM / 8 bytes a text, reach the driver,
where they are unpacked ``BATCH`` at a time. There are ``LANDMARKS`` landmarks a
language and ``MAX_LANDMARKS`` in all, fewer a language where languages are
many, so the model that is sent has some 22 MB at most. Everything else goes over all rows, and
nothing is shuffled.

A score of a half is the border of the known languages. The sample is also
scored in folds, each by a model of the others. A text's best value has to
reach half of what all but ``STRAYS`` of these texts reach, and 0 at least,
as a text with no value over 0 is rejected by every language; and so has the
share of the text's own kernel that the landmarks explain, which is near 0 for
other scripts and for noise. Under either the score is less than a half.

Defined results: ``und`` with score 0 for a null text, a text without a
letter, and for all texts if nothing is labelled. Equal texts get equal
results. A row without doc_id is not held out and not learnt from; rows that
share one are rows like others. Ties go to the language first by code point. An
empty table gives no rows. Columns named lang_pred and score are replaced, all
others pass through.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.encoding import text_slices
from tessera.llm.hashing import lean, settle
from tessera.llm.native import documents

MAX_N = 3
DIM = 1 << 13
#: Bounds of the fitting sample and of the landmarks, for each language.
SAMPLE = 400
LANDMARKS = 48
#: Landmarks of all languages; the root matrix is of this size squared.
MAX_LANDMARKS = 2048
RIDGE = 0.3
#: Parts of the sample that are scored by a model of the others, and the share of their texts that bounds do not heed.
FOLDS = 4
STRAYS = 0.002
#: Texts that are scored at once, DIM floats each.
BATCH = 256
_MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def _letters() -> np.ndarray:
    """For each code point of the basic plane, itself if a letter and else a space."""
    return np.array([i if chr(i).isalpha() else 32 for i in range(0x10000)], np.uint32)


_TABLE: np.ndarray | None = None


def presence(texts: list[str]) -> np.ndarray:
    """A row of DIM bytes for each text: 1 where it holds an n-gram of that hash."""
    global _TABLE
    if _TABLE is None:
        _TABLE = _letters()
    lowered = [t.lower() for t in texts]
    joined = " \0 ".join(lowered)
    codes = np.frombuffer(f" {joined} ".encode("utf-32-le", "surrogatepass"), "<u4")
    breaks = codes == 0
    c = np.where(codes < 0x10000, _TABLE[np.minimum(codes, 0xFFFF)], codes)
    # Runs of spaces are one space; the zero between texts is marked by doc.
    lengths = np.array([len(t) for t in lowered], np.int64)
    doc = np.repeat(np.arange(len(texts)), lengths + 3)[: len(c)]
    keep = np.ones(len(c), bool)
    keep[1:] = ~((c[1:] == 32) & (c[:-1] == 32) & (doc[1:] == doc[:-1])) & ~breaks[1:]
    c, doc = c[keep], doc[keep]
    out = np.zeros((len(texts), DIM), np.uint8)
    flat = out.reshape(-1)
    base = doc * DIM
    shift = np.uint32(32 - (DIM.bit_length() - 1))
    h = np.zeros(len(c), np.uint32)
    for n in range(MAX_N):
        part = c[n:] * np.uint32(_MULTIPLIERS[n]) if n else c * np.uint32(_MULTIPLIERS[0])
        h = (h[: len(part)] ^ part) * np.uint32(0x27D4EB2F)
        if not len(h):
            break
        same = doc[n:] == doc[: len(h)]
        flat[(base[: len(h)] + (h >> shift))[same]] = 1
    return out


def _floats(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Presence as floats, from bits, and the root of each row's count."""
    x = np.unpackbits(packed, axis=1).astype(np.float32)
    return x, np.sqrt(np.maximum(x.sum(axis=1), 1))


@dataclass
class Model:
    """Landmark presence (landmarks x DIM bits), their root (landmarks x features) and weights (landmarks x languages).

    ``floor`` and ``reach`` are what the best value and the explained share of a text in a known language reach.
    """

    langs: list[str]
    landmarks: np.ndarray
    root: np.ndarray
    weights: np.ndarray
    floor: float = 0.0
    reach: float = 0.0

    @cached_property
    def marks(self) -> np.ndarray:
        x, roots = _floats(self.landmarks)
        return x / roots[:, None]

    def kernel(self, packed: np.ndarray) -> np.ndarray:
        x, roots = _floats(packed)
        return (x @ self.marks.T) / roots[:, None]

    def look(self, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (texts x languages) and the explained share of each text."""
        k = self.kernel(packed)
        return k @ self.weights, np.square(k @ self.root).sum(axis=1)

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The best language of each text by its place, and its score."""
        values, share = self.look(np.packbits(presence(texts), axis=1))
        score = np.clip((values.max(axis=1) - self.floor + 1) / 2, 0, 1)
        far = share < self.reach
        score[far] = np.minimum(score[far], share[far] / self.reach / 2)
        return values.argmax(axis=1), score


def fit(packed: np.ndarray, langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Nystroem features of the sample on its landmarks, then ridge regression of +1 and -1; the sums go batch by batch."""
    names = sorted(set(langs))
    y = np.array([names.index(x) for x in langs])
    each = max(1, min(landmarks, MAX_LANDMARKS // len(names)))
    marked = np.concatenate([np.flatnonzero(y == k)[:each] for k in range(len(names))])
    model = Model(names, packed[marked], np.empty(0), np.empty(0))
    values, vectors = np.linalg.eigh((model.marks @ model.marks.T).astype(np.float64))
    good = values > 1e-6 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])
    signs = np.where(y[:, None] == np.arange(len(names)), 1.0, -1.0)
    inner, outer = ridge * np.eye(root.shape[1]), np.zeros((root.shape[1], len(names)))
    for a in range(0, len(packed), BATCH):
        features = model.kernel(packed[a : a + BATCH]).astype(np.float64) @ root
        inner += features.T @ features
        outer += features.T @ signs[a : a + BATCH]
    return Model(names, model.landmarks, root.astype(np.float32), (root @ np.linalg.solve(inner, outer)).astype(np.float32))


def fit_bounded(packed: np.ndarray, langs: list[str]) -> Model:
    """The model of all rows, its bounds from rows that were not learnt from."""
    model = fit(packed, langs)
    fold = np.arange(len(langs)) % FOLDS
    best, share = [], []
    for k in range(FOLDS if len(langs) >= FOLDS else 0):
        part, others = packed[fold == k], fit(packed[fold != k], [x for x, f in zip(langs, fold) if f != k])
        for a in range(0, len(part), BATCH):
            values, shares = others.look(part[a : a + BATCH])
            best.append(values.max(axis=1))
            share.append(shares)
    if best:
        model.floor = max(0.0, float(np.quantile(np.concatenate(best), STRAYS)) / 2)
        model.reach = float(np.quantile(np.concatenate(share), STRAYS)) / 2
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % 4 == 2, F.lit(False))


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, max_langs: int = 400) -> Model | None:
    """Fit on at most ``sample`` rows of each language; None if there are none."""
    rows = labelled.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")).where("id is not null and text is not null and lang is not null")
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().limit(max_langs + 1).collect()}
    if not counts:
        return None
    if len(counts) > max_langs:
        raise ValueError(f"over {max_langs} languages; raise max_langs if this is meant")
    # A share of each language by hash, a little over the bound, cut to it below.
    top = 1 << 31
    limit = F.create_map(*[F.lit(v) for lang, n in sorted(counts.items()) for v in (lang, min(top, int(top * (1.5 * sample + 20) / n)))])
    order = F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(top))

    @F.arrow_udf("binary")
    def packed(texts: pa.Array) -> pa.Array:
        lean()
        out: list[bytes] = []
        for _, values in text_slices(texts, rows=BATCH):
            out += [np.packbits(x).tobytes() for x in presence(values)]
        settle()
        return pa.array(out, pa.binary())

    chosen = rows.withColumn("o", order).where(F.col("o") < F.element_at(limit, F.col("lang"))).select("lang", "o", "id", packed("text").alias("bits")).collect()
    chosen.sort(key=lambda r: (r.lang, r.o, r.id, bytes(r.bits)))
    held: dict[str, int] = {}
    kept = []
    for r in chosen:
        held[r.lang] = held.get(r.lang, 0) + 1
        if held[r.lang] <= sample:
            kept.append(r)
    if not kept:
        return None
    return fit_bounded(np.frombuffer(b"".join(bytes(r.bits) for r in kept), np.uint8).reshape(len(kept), DIM // 8), [r.lang for r in kept])


def predict(text: Column, model: Model | None) -> Column:
    """A struct (lang, score) for a text."""
    @F.arrow_udf("lang string, score double")
    def look(texts: pa.Array) -> pa.Array:
        lean()
        langs, scores = [], []
        for _, values in text_slices(texts.fill_null(""), rows=BATCH):
            lang, score = ["und"] * len(values), [0.0] * len(values)
            some = [i for i, t in enumerate(values) if model is not None and any(map(str.isalpha, t))]
            if some:
                best, found = model.scores([values[i] for i in some])
                for i, k, s in zip(some, best.tolist(), found.tolist()):
                    lang[i], score[i] = model.langs[k], s
            langs += lang
            scores += score
        settle()
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return look(text)


def detect(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, which replace columns of those names."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), predict(F.col(f"`{text_col}`"), model).alias("_p"))
    return out.select("_row.*", F.col("_p.lang").alias("lang_pred"), F.col("_p.score").alias("score"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return detect(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), model).drop("text")
