"""Toxicity by a weighted finite-state grammar over clauses.

A lexicon transducer reads words and writes tags with weights: insults, threats, intentions, targets, negations and
words that report speech. Machines for insult, threat, target, negation and reported speech are composed into one
transducer, whose states know what the clause has said so far; it weighs every insult and threat by that (aimed at
somebody, announced, denied, quoted) and adds up the clause. A document's clause scores give its probability through
a logistic function.

The lexicon is learned: beginnings of words whose share among toxic training rows is far above that among clean
ones, weighted by the logarithm of the ratio, beside a few fixed words. Learning reads a sample of labelled training
rows (at most `SAMPLE` of each class); scoring reads every whole text. Only words with a tag enter the transducer;
all others are one symbol, of which it needs to see three at most.

Defined results: a null text is an empty one; a text without tagged words gets the lowest score. A row whose label is
null, or whose id or label row is missing, is not learned from; of several labels of one id the highest counts.
Without labels of both classes the fixed words and weights decide. Repeated rows are scored alike, an empty table
gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import Workspace, encode_dictionary, slices, split_words, texts_of
from shelfcast.llm.shingles import shingle_sets

SAMPLE, CACHED = 10_000, 600_000
#: Lengths of word beginnings that the lexicon may hold, most candidates, and when one is kept.
STEMS, CANDIDATES, LEAST_ROWS, LEAST_RATIO, LEAST_SIGMAS = range(3, 11), 200_000, 4, 6.0, 6.0

OTHER, INSULT, THREAT, INTENT, TARGET, NEGATION, REPORT = range(7)

#: Fixed words of the grammar, whole words, by tag.
WORDS = {
    INSULT: "idiot moron stupid scum loser worthless pathetic disgusting trash imbecile dumbass connard abruti crétin "
            "salaud dummkopf vollidiot arschloch abschaum estúpido imbécil gilipollas basura",
    THREAT: "kill hurt destroy beat stab shoot strangle tuer frapper détruire töten umbringen schlagen matar golpear",
    INTENT: "will gonna shall vais werde voy",
    TARGET: "you your yours they them he she him her tu toi vous du dich euch ihr tú te usted ustedes",
    NEGATION: "not never no isn't aren't don't nobody ne pas jamais nicht kein keine nunca jamás",
    REPORT: "said says called wrote quoted told allegedly dit disait appelé sagte nannte schrieb dijo llamó escribió",
}
FIXED_WEIGHT = 3.0
_TRIM = re.compile(r"^[^\w]+|[^\w]+$")
_CLAUSE_END = tuple(".!?;:")


# -- machines

class Machine:
    """States with a step for each tag, and a factor for what insults and threats weigh in a state."""

    def __init__(self, states: int, step, factor):
        self.states, self.step, self.factor = states, step, factor


def _recent(tag: int, span: int, weighed: int, factor: float) -> Machine:
    """Remembers `tag` for `span` symbols; `weighed` then has the factor."""
    return Machine(
        span + 1,
        lambda s, t: span if t == tag else max(s - 1, 0),
        lambda s, t: factor if s and t == weighed else 1.0,
    )


def _denied() -> Machine:
    return Machine(4, lambda s, t: 3 if t == NEGATION else max(s - 1, 0), lambda s, t: 0.3 if s else 1.0)


def _reported() -> Machine:
    return Machine(2, lambda s, t: 1 if t == REPORT else s, lambda s, t: 0.6 if s else 1.0)


def _insulting() -> Machine:
    """One insult upon another weighs more."""
    return Machine(3, lambda s, t: 2 if t == INSULT else max(s - 1, 0), lambda s, t: 1.2 if s and t == INSULT else 1.0)


class Composed:
    """Product of machines as one table: next state and factor by state and tag."""

    def __init__(self, machines: list[Machine]):
        states = list(product(*(range(m.states) for m in machines)))
        number = {s: i for i, s in enumerate(states)}
        tags = range(7)
        self.next = [
            [number[tuple(m.step(x, t) for m, x in zip(machines, s, strict=True))] for t in tags] for s in states
        ]
        self.factor = [
            [math.prod(m.factor(x, t) for m, x in zip(machines, s, strict=True)) for t in tags] for s in states
        ]
        self.longest_memory = max(m.states for m in machines) - 1

    def clause(self, symbols: list[tuple[int, int, float]]) -> float:
        """Weight of a clause; symbols are (place, tag, weight), places between them hold other words."""
        return sum(weight * factor for (_, _, weight), factor in zip(symbols, self.factors(symbols), strict=True))

    def factors(self, symbols: list[tuple[int, int, float]]) -> list[float]:
        """What the weight of each symbol is multiplied with where it stands; 0 for others than insults and threats."""
        state, at, found = 0, None, []
        for place, tag, _ in symbols:
            for _ in range(min(place - at - 1, self.longest_memory) if at is not None else 0):
                state = self.next[state][OTHER]
            found.append(self.factor[state][tag] if tag in (INSULT, THREAT) else 0.0)
            state, at = self.next[state][tag], place
        return found


def grammar() -> Composed:
    return Composed([
        _insulting(), _recent(INTENT, 3, THREAT, 2.0), _recent(TARGET, 3, INSULT, 1.3), _denied(), _reported(),
    ])


# -- lexicon

def trimmed(word: str) -> str:
    return _TRIM.sub("", word.lower())


class Lexicon:
    """Longest beginning, or whole fixed word, to (tag, weight)."""

    def __init__(self, stems: dict[str, float]):
        self.stems = stems
        self.lengths = sorted({len(s) for s in stems}, reverse=True)
        self.words = {w: (tag, FIXED_WEIGHT if tag in (INSULT, THREAT) else 0.0)
                      for tag, text in WORDS.items() for w in text.split()}
        self.cache: dict[str, tuple[int, float]] = {}

    def _tag(self, word: str) -> tuple[int, float]:
        word = trimmed(word)
        for n in self.lengths:
            weight = self.stems.get(word[:n]) if len(word) >= n else None
            if weight is not None:
                return (INSULT, weight)
        return self.words.get(word, (OTHER, 0.0))

    def tags(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cache = self.cache
        if len(cache) + len(words) > CACHED:
            cache.clear()
        found = []
        for w in words:
            t = cache.get(w)
            if t is None:
                t = cache[w] = self._tag(w)
            found.append(t)
        return np.array([t for t, _ in found], np.int8), np.array([x for _, x in found])


def features(texts: pa.Array, lexicon: Lexicon, machine: Composed) -> np.ndarray:
    """Per text: logarithms of the sum of its clause scores, of the highest, of the number of scored clauses, and of
    the sum for every hundred words."""
    offsets, words = split_words(texts)
    index, distinct = encode_dictionary(words)
    words = distinct.to_pylist()
    tag_of, weight_of = lexicon.tags(words)
    tags, weights = tag_of[index], weight_of[index]
    out = np.zeros((len(texts), 4))
    hits = (tags == INSULT) | (tags == THREAT)
    hit_rows = np.unique(np.searchsorted(offsets, np.flatnonzero(hits), side="right") - 1)
    ends = np.fromiter((w.endswith(_CLAUSE_END) for w in words), bool, len(words))
    for row in hit_rows.tolist():
        a, b = int(offsets[row]), int(offsets[row + 1])
        clause = np.concatenate([[0], np.cumsum(ends[index[a:b]])[:-1]])
        some = np.flatnonzero(tags[a:b] != OTHER)
        clauses: dict[int, list] = {}
        for place, c in zip(some.tolist(), clause[some].tolist(), strict=True):
            clauses.setdefault(c, []).append((place, int(tags[a + place]), float(weights[a + place])))
        # a word weighs once in a text, where it weighs most: boilerplate repeats a line, it does not make it worse
        most: dict[int, tuple[float, int]] = {}
        for c, symbols in clauses.items():
            for (place, _, weight), factor in zip(symbols, machine.factors(symbols), strict=True):
                word = int(index[a + place])
                if weight * factor > most.get(word, (0.0, c))[0]:
                    most[word] = weight * factor, c
        sums = dict.fromkeys(clauses, 0.0)
        for weight, c in most.values():
            sums[c] += weight
        scores = [s for s in sums.values() if s > 0]
        if scores:
            out[row] = np.log1p([sum(scores), max(scores), len(scores), 100 * sum(scores) / (b - a + 20)])
    return out


# -- learning

def _beginnings(texts: pa.Array) -> Iterator[set[str]]:
    offsets, words = split_words(texts)
    index, distinct = encode_dictionary(words)
    stems = []
    for w in distinct.to_pylist():
        w = trimmed(w)
        stems.append({w[:n] for n in STEMS if len(w) >= n})
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        yield set().union(*[stems[i] for i in np.unique(index[a:b])])


def _counted(wanted):
    """Rows that hold each beginning; with `wanted`, of those only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = set(wanted.value) if wanted else None
        counts: dict[str, int] = {}
        for batch in slices(batches, text=0):
            for stems in _beginnings(texts_of(batch.column(0))):
                for s in stems & only if only is not None else stems:
                    counts[s] = counts.get(s, 0) + 1
            if len(counts) > 1_000_000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], names=["stem", "n"])
                counts = {}
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], names=["stem", "n"])

    return run


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least hash of the three-word shingles, which near copies mostly share."""
    for batch in slices(batches, text=0):
        texts = texts_of(batch.column(0))
        sketch = [int(h[0]) if len(h) else 0 for h in shingle_sets(texts, 3)]
        yield pa.RecordBatch.from_arrays(
            [texts, batch.column(1).cast(pa.int32()), pa.array(np.array(sketch, np.uint64).view(np.int64))],
            names=["text", "toxic", "sketch"],
        )


def learn_stems(training: DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Beginnings that mark toxic rows, with their weights."""
    spark = training.sparkSession
    texts = training.select("text", "toxic")
    toxic = texts.where("toxic = 1").select("text").mapInArrow(_counted(None), "stem string, n long")
    toxic = toxic.groupBy("stem").agg(F.sum("n").alias("n")).where(F.col("n") >= max(LEAST_ROWS, n_toxic // 500))
    toxic = {r["stem"]: r["n"] for r in toxic.orderBy(F.desc("n"), "stem").limit(CANDIDATES).collect()}
    wanted = spark.sparkContext.broadcast(sorted(toxic))
    clean = texts.where("toxic = 0").select("text").mapInArrow(_counted(wanted), "stem string, n long")
    clean = {r["stem"]: r["n"] for r in clean.groupBy("stem").agg(F.sum("n").alias("n")).collect()}
    return chosen_stems(toxic, clean, n_toxic, n_clean)


def chosen_stems(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Beginnings by what they tell in all: a frequent one goes before its own extensions, unless one of those is in
    nearly as many toxic rows and so says the same more narrowly."""
    scored = []
    for stem, n in toxic.items():
        m = clean.get(stem, 0)
        ratio = ((n + 0.5) / (n_toxic + 1)) / ((m + 0.5) / (n_clean + 1))
        expected = (m + 0.5) / (n_clean + 1) * n_toxic
        if ratio >= LEAST_RATIO and n - expected >= LEAST_SIGMAS * math.sqrt(expected):
            scored.append((n * math.log(ratio), stem, math.log(ratio)))
    narrower: dict[str, str] = {}
    for _, stem, _ in sorted(scored, key=lambda x: len(x[1])):
        shorter = stem[:-1]
        if shorter in toxic and toxic[stem] >= 0.9 * toxic[shorter]:
            narrower[shorter] = stem
    kept: dict[str, float] = {}
    for _, stem, weight in sorted(scored, key=lambda x: (-x[0], x[1])):
        while stem in narrower:
            stem = narrower[stem]
        if not any(stem[:n] in kept for n in STEMS) and not any(k.startswith(stem) for k in kept):
            kept[stem] = weight
    return kept


def learn_weights(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights and a constant, both classes weighing the same, by Newton steps with a small ridge."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    scale = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (scale * (y - p)) - 1e-4 * w
        curve = (x * (scale * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


#: Used without labels: two insults, or one that is aimed at somebody, pass.
DEFAULT_WEIGHTS = np.array([2.0, 0.0, 0.0, 0.0, -2.5])


def learn(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], np.ndarray]:
    """Stems and weights from (id, text) and (id, toxic)."""
    work = Workspace(docs.sparkSession)
    known = labels.where("id is not null and toxic in (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))
    picked = [
        known.where(F.col("toxic") == k).orderBy(F.xxhash64("id"), "id").limit(SAMPLE) for k in (0, 1)
    ]
    # at most 2 * SAMPLE rows of two numbers
    chosen = F.broadcast(picked[0].union(picked[1]))
    found = docs.join(chosen, "id").select("text", "toxic").mapInArrow(_sketched, "text string, toxic int, sketch long")
    # copies say no more than one of them
    training = work.keep(found.dropDuplicates(["toxic", "sketch"]), "training")
    sizes = {r["toxic"]: r["count"] for r in training.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        work.clear()
        return {}, DEFAULT_WEIGHTS
    stems = learn_stems(training, sizes[1], sizes[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, machine = Lexicon(stems), grammar()
        for batch in slices(batches, text=0):
            x = features(texts_of(batch.column(0)), lexicon, machine)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c) for c in x.T), batch.column(1).cast(pa.int32())], names=["a", "b", "c", "d", "y"]
            )

    rows = training.mapInArrow(run, "a double, b double, c double, d double, y int").toPandas()
    work.clear()
    return stems, learn_weights(rows[["a", "b", "c", "d"]].to_numpy(), rows["y"].to_numpy())


def score(
    docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", threshold: float = 0.7, keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: id, the columns of `docs` named in `keep` as a struct `kept`, held_out, score (0 to 1), predicted
    (score >= threshold).

    Rows where `held_out`, a column over `docs`, is true are scored but not learned from.
    """
    source = docs.select(
        docs[id_col].alias("id"), docs[text_col].alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
        *([F.struct(*(docs[c] for c in keep)).alias("kept")] if keep else []),
    )
    model = docs.sparkSession.sparkContext.broadcast(learn(
        source.where(~F.col("held_out")).select("id", "text"),
        labels.select(labels[id_col].alias("id"), labels[label_col].alias("toxic")),
    ))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stems, weights = model.value
        lexicon, machine = Lexicon(stems), grammar()
        for batch in slices(batches):
            x = features(texts_of(batch.column(1)), lexicon, machine)
            p = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:], pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                names=["id", *batch.schema.names[2:], "score", "predicted"],
            )

    rest = "".join(f", {f.name} {f.dataType.simpleString()}" for f in source.schema[2:])
    out = source.mapInArrow(run, f"id {source.schema[0].dataType.simpleString()}{rest}, score double, predicted int")
    return out.withColumnRenamed("id", id_col)
