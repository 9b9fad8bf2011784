"""Toxicity by a weighted finite-state pattern grammar.

Words are read as symbols: insult (strong or weak), threat, target (whoever is
addressed), negation and reported speech; sentence and clause marks are symbols
too.  Four small transducers read the symbols: one knows whether a negation is near,
one whether speech is reported, one whether somebody is addressed before the word,
one whether right after it.  Their composition is one deterministic transducer whose
arcs put out events: "strong insult, addressed", "weak insult, negated, reported" and
so on.  A document's score is a logistic function of its weighted events, so a
negated or quoted insult counts by its own weight and a word alone is no verdict.

The grammar brings a basic lexicon and prior weights.  Labelled documents add words
and word stems that stand in toxic documents far more often than by chance, and
move the weights from their priors (a maximum a posteriori fit).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from crease.llm.common import bounded_sample, cut, frugal, small_batches
from crease.llm.shingles import shingle_hashes

#: Labelled documents of the training sample at most; learned words and stems at most; lengths of stems.
SAMPLE, LEXICON, STEMS = 20_000, 5_000, range(4, 9)
#: A score of this or more is called toxic.
TOXIC = 0.7

OTHER, STRONG, WEAK, THREAT, TARGET, NEGATION, REPORT, SOFT, HARD = range(9)
_BASIC = {
    STRONG: "idiot idiots moron morons imbecile scum loser losers stupid pathetic worthless disgusting trash bastard asshole "
            "clown retard filth vermin dumbass jerk trottel arschloch abschaum dummkopf schwachkopf hurensohn vollidiot "
            "imbécil estúpido estúpida basura escoria gilipollas idiota cabrón connard connasse salaud ordure abruti crétin débile",
    THREAT: "kill murder stab shoot strangle hang burn destroy hurt töten umbringen abstechen erschießen matar mataré quemar "
            "tuer tuerai égorger brûler",
    TARGET: "you your yours yourself u ur du dich dir dein deine euch ihr tú te ti tu usted ustedes vosotros toi vous ton ta vos",
    NEGATION: "not no never isn wasn aren don doesn didn nobody without nicht kein keine nie niemals nunca jamás sin pas jamais sans",
    REPORT: "said says say wrote writes quoted quotes claimed claims called reported reports asked replied sagte sagt schrieb "
            "behauptete nannte dijo dice escribió afirmó llamó dit disait écrit affirmé appelé",
}
_MARKS = {**dict.fromkeys(".!?;\n", HARD), **dict.fromkeys(",:\"“”«»()", SOFT)}
_WORDS = re.compile(r"\w+").findall
_TOKENS = re.compile(r"\w+|[.!?;\n,:\"“”«»()]")


@dataclass
class Transducer:
    """``after[state, symbol]`` is the next state, ``tag[state, symbol]`` what it puts out (0 or 1)."""

    after: np.ndarray
    tag: np.ndarray


def countdown(opens: set[int], reach: int, reads: set[int], ends: set[int]) -> Transducer:
    """Opened by some symbols for the ``reach`` tokens after them; puts out a 1 for
    the symbols ``reads`` within; ``ends`` close it."""
    after, tag = np.zeros((reach + 1, 9), int), np.zeros((reach + 1, 9), int)
    for state, symbol in product(range(reach + 1), range(9)):
        after[state, symbol] = reach if symbol in opens else 0 if symbol in ends else max(0, state - 1)
        tag[state, symbol] = int(state > 0 and symbol in reads)
    return Transducer(after, tag)


def latch(opens: set[int], reads: set[int], ends: set[int]) -> Transducer:
    """As ``countdown``, without an end but ``ends``."""
    out = countdown(opens, 1, reads, ends)
    out.after[1] = [0 if s in ends else 1 for s in range(9)]
    return out


def compose(*parts: Transducer) -> Transducer:
    """The transducer that runs all ``parts`` at once; part k's tag is bit k of its own."""
    sizes = [len(p.after) for p in parts]
    states = list(product(*map(range, sizes)))
    number = {s: k for k, s in enumerate(states)}
    after, tag = np.zeros((len(states), 9), int), np.zeros((len(states), 9), int)
    for s, k in number.items():
        for symbol in range(9):
            after[k, symbol] = number[tuple(int(p.after[x, symbol]) for p, x in zip(parts, s))]
            tag[k, symbol] = sum(int(p.tag[x, symbol]) << bit for bit, (p, x) in enumerate(zip(parts, s)))
    return Transducer(after, tag)


_HITS = {STRONG, WEAK, THREAT}
#: Bits of a tag: negated, reported, addressed before, and (on a target) addressed right after.
GRAMMAR = compose(countdown({NEGATION}, 3, _HITS, {SOFT, HARD}), latch({REPORT}, _HITS, {HARD}),
                  countdown({TARGET}, 4, _HITS, {SOFT, HARD}), countdown(_HITS, 3, {TARGET}, {SOFT, HARD}))
EVENTS = 3 * 8 + 1


def _event(symbol: int, tag: int) -> int:
    """Number of the event of an arc; -1 for none."""
    if symbol in _HITS:
        return 8 * (symbol - 1) + (tag & 7)
    return EVENTS - 1 if tag & 8 else -1


_ARCS = [[(int(GRAMMAR.after[s, c]), _event(c, int(GRAMMAR.tag[s, c]))) for c in range(9)] for s in range(len(GRAMMAR.after))]


def event_name(event: int) -> str:
    if event == EVENTS - 1:
        return "addressed after"
    kind, tag = divmod(event, 8)
    return " ".join([("strong insult", "weak insult", "threat")[kind],
                     *[name for bit, name in enumerate(("negated", "reported", "addressed")) if tag >> bit & 1]])


def prior() -> np.ndarray:
    """Weights before any label: one per event's log count, one per event's share
    of the words (in per cent), and the constant."""
    first = np.zeros(EVENTS)
    for event in range(EVENTS - 1):
        kind, tag = divmod(event, 8)
        weight = (2.0, 0.5, 0.3)[kind] + ((0.7, 0.5, 1.5)[kind] if tag & 4 else 0)
        first[event] = weight * (0.4 if tag & 1 else 1) * (0.5 if tag & 2 else 1)
    first[-1] = 0.5
    return np.concatenate([first, np.zeros(EVENTS), [-3.0]])


@dataclass
class Model:
    """Symbols of words, symbols of stems, and the weights of ``prior``'s layout."""

    words: dict[str, int]
    stems: dict[str, int]
    weights: np.ndarray


def basic() -> Model:
    return Model({w: s for s, ws in _BASIC.items() for w in ws.split()} | _MARKS, {}, prior())


class Symbols(dict):
    """Symbols of lower-cased words, each looked up once (bounded cache)."""

    def __init__(self, model: Model):
        super().__init__()
        self.words, self.stems, self.lengths = model.words, model.stems, sorted({len(s) for s in model.stems}, reverse=True)

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        symbol = self.words.get(word)
        if symbol is None:
            symbol = next((self.stems[word[:k]] for k in self.lengths if len(word) > k and word[:k] in self.stems), OTHER)
        self[word] = symbol
        return symbol


def events_of(text: str, symbols: Symbols) -> tuple[np.ndarray, int, list[tuple[int, int, int]]]:
    """Counts of the events of a text, its number of words, and its matches
    (event, start, end), where start and end are code points."""
    low, counts, found = text.lower(), np.zeros(EVENTS), []
    words = _WORDS(low)
    if _HITS.isdisjoint(map(symbols.__getitem__, words)):
        return counts, len(words), found
    # lower-casing may change a text's length ("İ"): places are those of the text itself
    state = 0
    for m in _TOKENS.finditer(text if len(low) != len(text) else low):
        state, event = _ARCS[state][symbols[m.group().lower()]]
        if event >= 0:
            counts[event] += 1
            found.append((event, m.start(), m.end()))
    return counts, len(words), found


def features(counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Rows of log counts, shares of the words in per cent (5 at most), and 1."""
    share = np.minimum(5, 100 * counts / np.maximum(1, words)[:, None])
    return np.concatenate([np.log1p(counts), share, np.ones((len(counts), 1))], axis=1)


def logistic(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, mean: np.ndarray, strength: float = 1.0) -> np.ndarray:
    """Maximum a posteriori weights of a logistic score with normal priors around
    ``mean`` (Newton's method, halving steps that do not help); the constant is free."""
    w, keep = mean.copy(), np.append(np.full(len(mean) - 1, strength), 1e-6)

    def loss(v: np.ndarray) -> float:
        z = np.clip(x @ v, -40, 40)
        return float(np.sum(np.logaddexp(0, z) - y * z) + 0.5 * np.sum(keep * (v - mean) ** 2))

    now = loss(w)
    for _ in range(60):
        p = logistic(x, w)
        slope = x.T @ (p - y) + keep * (w - mean)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), slope)
        rate = 1.0
        while rate > 1e-6 and loss(w - rate * step) > now:
            rate /= 2
        w = w - rate * step
        before, now = now, loss(w)
        if before - now < 1e-9 * max(1.0, before):
            break
    return w


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from training; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
           size: int = SAMPLE) -> DataFrame:
    """(y, t) of at most ``size`` labelled rows that are not held out.  Of texts
    with the same label and the same least shingle hash, as copies have, one stays:
    the words of a text copied a thousand times are no evidence of a thousand."""
    picked = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y")) \
        .filter(F.col("y").isin(0, 1) & F.col("i").isNotNull() & ~held_out("i"))
    picked = bounded_sample(picked, size, "i", "y")
    rows = docs.select(F.col(id_col).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).join(F.broadcast(picked), "i")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = []
            for t in batch.column(2):
                hashes = shingle_hashes(t.as_py())
                least.append(f"{int(hashes.min()):x}" if len(hashes) else "short " + t.as_py().lower())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.string())], ["i", "y", "t", "least"])

    alike = Window.partitionBy("y", "least").orderBy("i", "t")
    return rows.select("i", "y", "t").mapInArrow(frugal(sketch), "i {}, y int, t string, least string".format(
        rows.schema["i"].dataType.simpleString())).withColumn("nth", F.row_number().over(alike)) \
        .filter("nth = 1").select("y", "t")


def _term_counts(rows: DataFrame, terms) -> DataFrame:
    """(term, pos, neg): toxic and clean documents of (y, t) that hold a term of ``terms(words)``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()),
                                               *[pa.array([v[j] for v in held.values()], pa.int64()) for j in (1, 0)]], ["term", "pos", "neg"])

        for batch in batches:
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                for term in terms(set(_WORDS(t.as_py().lower()))):
                    held.setdefault(term, [0, 0])[y] += 1
                if len(held) > 200_000:
                    yield out()
                    held = {}
        if held:
            yield out()

    return rows.mapInArrow(frugal(count), "term string, pos long, neg long") \
        .groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _telling(counts: DataFrame, toxic: int, clean: int, most: int) -> list:
    """Terms in far more toxic documents than chance explains (log likelihood ratio
    of 25 or more), and the share of toxic documents among those that hold each."""
    n = toxic + clean
    pos, neg = F.col("pos"), F.col("neg")
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    both = (pos + neg) / F.lit(float(n))
    ratio = 2 * (part(pos, both * toxic) + part(neg, both * clean) + part(toxic - pos, (1 - both) * toxic)
                 + part(clean - neg, (1 - both) * clean))
    right = (pos + 0.5) / (pos + neg + 1)
    return counts.filter((pos >= 4) & (right >= max(0.3, min(0.7, 2.5 * toxic / n)))) \
        .select("term", ratio.alias("ratio"), right.alias("right")).filter("ratio >= 25") \
        .orderBy(F.desc("ratio"), "term").limit(most).collect()


def learn_lexicon(rows: DataFrame, most: int = LEXICON) -> Model:
    """The basic model with learned words and stems: strong insults where nearly all
    documents that hold the term are toxic, weak ones where far more are than usual.
    A stem is learned from words that are not known themselves, three at least, so
    that a known word's beginning is no insult."""
    toxic, clean = rows.agg(F.sum("y"), F.sum(1 - F.col("y"))).first()
    model = basic()
    if not toxic or not clean:
        return model
    words = cut(_term_counts(rows, lambda words: words))
    for r in _telling(words, toxic, clean, most):
        if model.words.get(r["term"], WEAK) == WEAK:
            model.words[r["term"]] = STRONG if r["right"] >= 0.7 else WEAK
    known = frozenset(model.words)

    def stems(found: set[str]) -> set[str]:
        return {w[:k] for w in found - known for k in STEMS if len(w) > k}

    several = words.filter((F.col("pos") > 0) & ~F.col("term").isin(*known)).select(F.explode(F.array(*[
        F.when(F.length("term") > k, F.substring("term", 1, k)) for k in STEMS])).alias("term")) \
        .filter(F.col("term").isNotNull()).groupBy("term").count().filter(F.col("count") >= 3).select("term")
    for r in _telling(_term_counts(rows, stems).join(several, "term"), toxic, clean, most):
        model.stems[r["term"]] = STRONG if r["right"] >= 0.7 else WEAK
    return model


def train_on(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             size: int = SAMPLE) -> Model:
    """Lexicon and weights from a bounded sample (``sample``) of the labelled rows
    that are not held out; its event counts, some numbers a row, are fitted on the
    driver.  Without two classes the grammar's own words and weights stay."""
    rows = cut(sample(docs, labels, id_col, text_col, label_col, size))
    model = learn_lexicon(rows)
    counted = _counted(rows, "t", model).select("y", "__words", "__events").collect()
    y = np.array([r["y"] for r in counted], float)
    if len(set(y)) < 2:
        return model
    counts = np.array([list(r["__events"]) for r in counted], float)
    order = np.lexsort([*counts.T, y])  # sums in one order, whatever the tasks'
    x = features(counts, np.array([r["__words"] for r in counted], float))
    return Model(model.words, model.stems, fit(x[order], y[order], model.weights))


def _counted(rows: DataFrame, text_col: str, model: Model) -> DataFrame:
    small_batches(rows.sparkSession)
    shared, at = rows.sparkSession.sparkContext.broadcast(model), rows.columns.index(text_col)
    kept = [k for k in range(len(rows.columns)) if k != at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols(shared.value)
        for batch in batches:
            got = [events_of(t.as_py() or "", symbols) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in kept], pa.array([n for _, n, _ in got], pa.int64()),
                 pa.array([c.tolist() for c, _, _ in got], pa.list_(pa.float64()))],
                [*[batch.schema.names[k] for k in kept], "__words", "__events"])

    fields = [f for k, f in enumerate(rows.schema.fields) if k in kept]
    counted = [StructField("__words", LongType()), StructField("__events", ArrayType(DoubleType()))]
    return rows.mapInArrow(frugal(run), StructType([*fields, *counted]))


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with the toxicity (0 to 1) of every whole text as ``out_col``; a
    column of that name is replaced.  Null and empty texts get the score of no
    event; repeated rows get equal scores; an empty table stays empty; other columns
    pass through, whatever their names.  Texts of any length are read whole, the
    transducer holds one state."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at, kept = docs.columns.index(text_col), [k for k, c in enumerate(docs.columns) if c != out_col]
    out = StructType([*[docs.schema.fields[k] for k in kept], StructField(out_col, DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        symbols = Symbols(own)
        for batch in batches:
            got = [events_of(t.as_py() or "", symbols)[:2] for t in batch.column(at)]
            counts = np.array([c for c, _ in got]).reshape(-1, EVENTS)
            values = logistic(features(counts, np.array([n for _, n in got], float)), own.weights)
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in kept], pa.array(values, pa.float64())],
                                             [*[batch.schema.names[k] for k in kept], out_col])

    return docs.mapInArrow(frugal(run), out)


def matches(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, start, end, event): every matched word of every text with its
    place in code points and the name of its event.  Texts without a match give no row."""
    small_batches(docs.sparkSession)
    shared, names = docs.sparkSession.sparkContext.broadcast(model), [event_name(e) for e in range(EVENTS)]
    rows = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    out = StructType([rows.schema.fields[0]]).add("start", "long").add("end", "long").add("event", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols(shared.value)
        for batch in batches:
            found = [(k, s, e, names[event]) for k, t in enumerate(batch.column(1))
                     for event, s, e in events_of(t.as_py() or "", symbols)[2]]
            if found:
                k, s, e, event = zip(*found)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(k)), pa.array(s, pa.int64()),
                                                  pa.array(e, pa.int64()), pa.array(event)], [id_col, "start", "end", "event"])

    return rows.mapInArrow(frugal(run), out)
