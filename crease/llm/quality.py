"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages.  Every passage is encoded from word-shape means,
repetition and a hashed bag of words; gated attention weights the passages, and
the weighted representation is scored.  Encoder, attention and score are learned
together from labels of whole documents.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from crease.llm.common import bounded_sample, frugal, small_batches

#: Words of a passage at most; bins of its bag of words.
PASSAGE, BINS = 96, 64
#: Labelled documents of the training sample, and the longest text that may be in it.
SAMPLE, SAMPLE_CHARS = 4_000, 200_000
_TRAITS = 10
WIDTH = _TRAITS + 4 + BINS
_CACHE = 200_000


class Words:
    """Traits of words, computed once per distinct word (bounded cache)."""

    def __init__(self):
        self.index, self.rows, self.bins = {}, array("f"), array("B")
        self.table = None

    def _trait(self, word: str) -> None:
        n = len(word)
        letters = sum(map(str.isalpha, word))
        upper = sum(map(str.isupper, word))
        digits = sum(map(str.isdigit, word))
        odd = n - letters - digits
        self.rows.extend((min(n, 40) / 10, upper / n, digits / n, odd / n, float(odd > 1), 1 - len(word.encode("ascii", "ignore")) / n,
                          float(upper > 1 and upper == letters), float(word[0].isupper()), float(word[-1] in ".!?"),
                          float(letters == 0)))
        self.bins.append(zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % BINS)

    def of(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Words of all texts as table rows, and the number in each text."""
        if len(self.index) > _CACHE:
            self.__init__()
        index, seqs = self.index, []
        for text in texts:
            words = text.split()
            for w in set(words).difference(index):
                index[w] = len(index)
                self._trait(w)
            seqs.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
        self.table = np.frombuffer(self.rows.tobytes(), np.float32).reshape(-1, _TRAITS)
        return np.concatenate(seqs) if seqs else np.zeros(0, np.int64), np.array([len(s) for s in seqs], np.int64)


def passages(texts: list[str], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages, and each one's text number.  A text of n
    words is cut evenly into ceil(n / PASSAGE) passages; a blank text is one
    passage of zeros."""
    flat, sizes = words.of(texts)
    count = np.maximum(1, -(-sizes // PASSAGE))
    first = np.cumsum(count) - count
    owner = np.repeat(np.arange(len(sizes)), count)
    text = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = first[text] + place * count[text] // np.maximum(1, sizes)[text]
    n = int(count.sum())
    held = np.bincount(at, minlength=n).astype(np.float32)
    share = 1 / np.maximum(1, held)
    out = np.zeros((n, WIDTH), np.float32)
    for k in range(_TRAITS):
        out[:, k] = np.bincount(at, weights=words.table[flat, k], minlength=n) * share
    length = words.table[flat, 0]
    out[:, _TRAITS] = np.sqrt(np.maximum(0, np.bincount(at, weights=length * length, minlength=n) * share - out[:, 0] ** 2))
    same = (flat[1:] == flat[:-1]) & (at[1:] == at[:-1])
    out[:, _TRAITS + 1] = np.bincount(at[1:], weights=same, minlength=n) * share if len(flat) else 0
    bag = np.bincount(at * BINS + np.frombuffer(words.bins.tobytes(), np.uint8).astype(np.int64)[flat], minlength=n * BINS).reshape(n, BINS) * share[:, None] \
        if len(flat) else np.zeros((n, BINS))
    out[:, _TRAITS + 2] = (bag ** 2).sum(axis=1)
    out[:, _TRAITS + 3] = np.log1p(held)
    out[:, _TRAITS + 4:] = np.sqrt(bag)
    return out, owner


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Encoder, gated attention and score; ``p`` holds the weights by name."""

    def __init__(self, p: dict[str, np.ndarray], mean: np.ndarray, scale: np.ndarray):
        self.p, self.mean, self.scale = p, mean, scale

    def forward(self, rows: np.ndarray, owner: np.ndarray, bags: int):
        p = self.p
        x = np.clip((rows - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["We"] + p["be"])
        v, u = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (v * u) @ p["w"]
        top = np.full(bags, -np.inf)
        np.maximum.at(top, owner, e)
        a = np.exp(e - top[owner])
        a /= np.bincount(owner, weights=a, minlength=bags)[owner]
        z = np.zeros((bags, h.shape[1]))
        np.add.at(z, owner, a[:, None] * h)
        return x, h, v, u, a, z, _sigmoid(z @ p["ws"] + p["bs"])

    def scores(self, rows: np.ndarray, owner: np.ndarray, bags: int) -> np.ndarray:
        return self.forward(rows, owner, bags)[-1]


def fit(texts: list[str], labels: list[int], hidden: int = 24, gate: int = 12, epochs: int = 40, batch: int = 64,
        rate: float = 0.01, penalty: float = 1e-4, seed: int = 11) -> Model:
    """Model of least log loss (Adam).  Without two classes the score is the
    constant share of label 1 (a half where there are no labels)."""
    draw = np.random.default_rng(seed)
    words, parts = Words(), []
    for start in range(0, len(texts), 500):
        rows, owner = passages(texts[start:start + 500], words)
        parts += np.split(rows, np.flatnonzero(np.diff(owner)) + 1)
    y = np.array(labels, float)
    everything = np.concatenate(parts) if parts else np.zeros((1, WIDTH), np.float32)
    p = {"We": draw.normal(0, WIDTH ** -0.5, (WIDTH, hidden)), "be": np.zeros(hidden),
         "V": draw.normal(0, hidden ** -0.5, (hidden, gate)), "U": draw.normal(0, hidden ** -0.5, (hidden, gate)),
         "w": draw.normal(0, gate ** -0.5, gate), "ws": draw.normal(0, hidden ** -0.5, hidden), "bs": np.zeros(1)}
    model = Model(p, everything.mean(axis=0), everything.std(axis=0) + 1e-3)
    if len(set(labels)) < 2:
        share = min(1 - 1e-9, max(1e-9, y.mean())) if len(y) else 0.5
        p["ws"][:], p["bs"][:] = 0, np.log(share / (1 - share))
        return model
    m1, m2, t = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for epoch in range(epochs):
        order = draw.permutation(len(y))
        for start in range(0, len(y), batch):
            pick = order[start:start + batch]
            rows = np.concatenate([parts[i] for i in pick])
            owner = np.repeat(np.arange(len(pick)), [len(parts[i]) for i in pick])
            x, h, v, u, a, z, s = model.forward(rows, owner, len(pick))
            d = (s - y[pick]) / len(pick)
            g = {"ws": z.T @ d, "bs": d.sum(keepdims=True)}
            dz = d[:, None] * p["ws"]
            dh = a[:, None] * dz[owner]
            da = (dz[owner] * h).sum(axis=1)
            de = a * (da - np.bincount(owner, weights=a * da, minlength=len(pick))[owner])
            g["w"] = (v * u).T @ de
            dg = de[:, None] * p["w"]
            dv, du = dg * u * (1 - v * v), dg * v * u * (1 - u)
            g["V"], g["U"] = h.T @ dv, h.T @ du
            dh = (dh + dv @ p["V"].T + du @ p["U"].T) * (1 - h * h)
            g["We"], g["be"] = x.T @ dh, dh.sum(axis=0)
            t += 1
            step = rate * (0.5 if epoch > epochs * 0.6 else 1)
            for k in p:
                grad = g[k] + (penalty * p[k] if k[0] != "b" else 0)
                m1[k] = 0.9 * m1[k] + 0.1 * grad
                m2[k] = 0.999 * m2[k] + 0.001 * grad * grad
                p[k] -= step * (m1[k] / (1 - 0.9 ** t)) / (np.sqrt(m2[k] / (1 - 0.999 ** t)) + 1e-8)
    return model


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from training; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def train_on(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Model of at most ``sample`` labelled rows that are not held out, the first
    in the order of a hash of the id; longer texts than ``sample_chars`` and null
    labels or ids are left out of the sample (not of the scoring)."""
    picked = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y")) \
        .filter(F.col("y").isin(0, 1) & F.col("i").isNotNull() & ~held_out("i"))
    picked = bounded_sample(picked, sample, "i", "y")
    texts = docs.select(F.col(id_col).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t")) \
        .filter(F.length("t") <= sample_chars)
    rows = bounded_sample(texts.join(F.broadcast(picked), "i"), sample, "i", "y", "t").collect()
    rows = sorted(rows, key=lambda r: (r["i"], r["y"], r["t"]))
    return fit([r["t"] for r in rows], [r["y"] for r in rows])


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score", least: float | None = None,
          flush_chars: int = 4_000_000) -> DataFrame:
    """``docs`` with the score (0 to 1) of every whole text as ``out_col``, or,
    with ``least``, the rows of at least that score, columns as they were.

    A null or empty text is scored as one passage without words; very long texts are
    read whole.  One row per row, an empty table stays empty; a column named
    ``out_col`` is replaced, others pass through; the model (some thousand numbers)
    is all that goes to every task.
    """
    docs = docs.drop(out_col) if least is None else docs
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    out = docs.schema if least is not None else StructType([*docs.schema.fields, StructField(out_col, DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, words = shared.value, Words()

        def scored(texts: list[str]) -> np.ndarray:
            rows, owner = passages(texts, words)
            return own.scores(rows, owner, len(texts))

        for batch in batches:
            got, texts, chars = [], [], 0
            for t in batch.column(at):
                texts.append(t.as_py() or "")
                chars += len(texts[-1])
                if chars >= flush_chars:
                    got.append(scored(texts))
                    texts, chars = [], 0
            got.append(scored(texts) if texts else np.zeros(0))
            values = np.concatenate(got)
            if least is not None:
                yield batch.filter(pa.array(values >= least))
            else:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())],
                                                 [*batch.schema.names, out_col])

    return docs.mapInArrow(frugal(run), out)
