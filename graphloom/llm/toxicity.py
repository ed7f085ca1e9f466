"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Examples are a bounded sample of labelled documents, indexed by the terms that tell the two labels apart: words,
and words' first letters as crude stems, which hold where a language inflects.  The inverted index keeps, for each term and each block of examples, the largest weight; a query visits blocks by
their upper bound and stops when no block left can reach its k-th neighbour, so neighbours are exact.  The
similarity-weighted vote of the neighbours is calibrated on the examples themselves, each left out in turn.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import in_small_batches, row_batches, text_of

#: labelled rows fitted on at most, the first by a hash of their id
EXAMPLES = 10_000
#: a term is indexed from this squared correlation with the label on (chi-square over the number of examples), a measure
#: that does not grow with the examples.  Squared correlations sum to at most the mean distinct terms of a toxic example
#: plus those of a clean one, so the index holds at most 1 / PHI_SQUARE times that sum, however many examples there are.
PHI_SQUARE = 0.01
#: a term of a single example has no other to be near to
LEAST_EXAMPLES = 2
#: letters of a stem
STEMS = (4, 5, 6)
NEIGHBOURS = 15
BLOCK = 64
BINS = 10
#: words whose terms a worker keeps
CACHE = 500_000

_LOWER_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[str]:
    return text.lower().encode("utf-8", "replace").translate(_LOWER_WORDS).decode("utf-8", "replace").split()


def terms_of(word: str) -> list[str]:
    """The word and its stems; a stem is marked, so that it is not taken for a word."""
    return [word, *[f"{word[:n]}^" for n in STEMS if len(word) > n]]


class _Places(dict):
    """Word -> places of its indexed terms."""

    def __init__(self, place: dict[str, int]) -> None:
        super().__init__()
        self.place = place

    def __missing__(self, word: str) -> list[int]:
        if len(self) > CACHE:
            self.clear()
        found = self[word] = [self.place[t] for t in terms_of(word) if t in self.place]
        return found


class Index:
    """Inverted lists of unit TF-IDF vectors with block maxima."""

    def __init__(self, terms: list[str], idf: np.ndarray, ids: list, labels: np.ndarray, counts: list[dict[int, int]],
                 silent: tuple[int, int]) -> None:
        """``counts``: uses of each indexed term by example; ``silent``: (examples, toxic ones) without any."""
        self.places = _Places({t: i for i, t in enumerate(terms)})
        self.idf, self.ids, self.labels = idf, ids, labels
        self.blocks = -(-len(ids) // BLOCK)
        lists: list[list[tuple[int, float]]] = [[] for _ in terms]
        for example, uses in enumerate(counts):
            for word, weight in self.vector(uses):
                lists[word].append((example, weight))
        self.examples = [np.array([e for e, _ in li], np.int64) for li in lists]
        self.weights = [np.array([w for _, w in li]) for li in lists]
        # where each block starts in each list, and its largest weight
        edges = np.arange(self.blocks + 1) * BLOCK
        self.starts = [np.searchsorted(e, edges) for e in self.examples]
        self.most = np.zeros((len(terms), self.blocks))
        for w, (e, v) in enumerate(zip(self.examples, self.weights, strict=True)):
            np.maximum.at(self.most[w], e // BLOCK, v)
        positive, total = int(labels.sum()) + silent[1], len(ids) + silent[0]
        self.base = positive / total if total else 0.0
        self.silent = (silent[1] + self.base) / (silent[0] + 1)
        self._calibrate(counts)

    def vector(self, uses: dict[int, int]) -> list[tuple[int, float]]:
        weights = [(w, (1.0 + np.log(n)) * self.idf[w]) for w, n in sorted(uses.items())]
        norm = np.sqrt(sum(x * x for _, x in weights))
        return [(w, x / norm) for w, x in weights]

    def uses(self, words: list[str]) -> dict[int, int]:
        return dict(Counter(t for terms in map(self.places.__getitem__, words) if terms for t in terms))

    def nearest(self, uses: dict[int, int], without: int = -1) -> list[tuple[float, int]]:
        """The most similar examples (similarity, example), most similar first, first examples at ties."""
        query = self.vector(uses)
        bound = sum(x * self.most[w] for w, x in query)
        best: list[tuple[float, int]] = []
        for block in np.argsort(-bound, kind="stable"):
            if bound[block] <= 0 or len(best) == NEIGHBOURS and bound[block] < best[-1][0] - 1e-12:
                break
            scores = np.zeros(BLOCK)
            for w, x in query:
                low, high = self.starts[w][block], self.starts[w][block + 1]
                scores[self.examples[w][low:high] - block * BLOCK] += x * self.weights[w][low:high]
            found = [(float(scores[i]), int(block * BLOCK + i)) for i in np.flatnonzero(scores > 0) if block * BLOCK + i != without]
            best = sorted(best + found, key=lambda b: (-round(b[0], 12), b[1]))[:NEIGHBOURS]
        return best

    def vote(self, near: list[tuple[float, int]]) -> float:
        weights = np.array([s * s for s, _ in near])
        return float(weights @ self.labels[[e for _, e in near]] / weights.sum())

    def _calibrate(self, counts: list[dict[int, int]]) -> None:
        """Monotone rate of toxic examples by vote, each example voted on by the others."""
        seen, toxic = np.zeros(BINS), np.zeros(BINS)
        for example, uses in enumerate(counts):
            near = self.nearest(uses, example)
            if near:
                b = min(BINS - 1, int(self.vote(near) * BINS))
                seen[b] += 1
                toxic[b] += self.labels[example]
        middle = (np.arange(BINS) + 0.5) / BINS
        pools = [[s + 1.0, t + m, 1] for s, t, m in zip(seen, toxic, middle, strict=True)]  # one pseudo-example at its own vote
        out: list[list[float]] = []
        for pool in pools:
            out.append(pool)
            while len(out) > 1 and out[-2][1] / out[-2][0] > out[-1][1] / out[-1][0]:
                s, t, n = out.pop()
                out[-1] = [out[-1][0] + s, out[-1][1] + t, out[-1][2] + n]
        self.rates = np.concatenate([np.full(int(n), t / s) for s, t, n in out])
        self.middle = middle

    def score(self, words: list[str]) -> tuple[float, list[tuple[float, int]]]:
        """(calibrated score, neighbours) of a text."""
        uses = self.uses(words)
        near = self.nearest(uses) if uses and self.ids else []
        if not near:
            return self.silent, []
        return float(np.interp(self.vote(near), self.middle, self.rates)), near


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
        examples: int = EXAMPLES) -> Index:
    """Index of the labelled rows; a row labelled twice counts by the mean of its labels, null labels not at all.

    The sample of at most ``examples`` rows is what the driver sees; document frequencies for IDF are counted over
    all of ``docs``.
    """
    marked = labels.filter(F.col(label_column).isNotNull() & F.col(id_column).isNotNull()).groupBy(id_column) \
        .agg((F.avg(label_column) >= 0.5).cast("int").alias("label"))
    chosen = marked.orderBy(F.xxhash64(id_column), id_column).limit(examples)
    # at most ``examples`` ids are broadcast
    texts = in_small_batches(docs).select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    candidates = texts.join(F.broadcast(chosen.withColumnRenamed(id_column, "id")), "id").withColumn("text_key", F.xxhash64("text"))
    # rows that repeat id and text are one example, and an id may stand on any number of rows: the rows are bounded
    rows = candidates.select("id", "text_key").distinct().orderBy(F.xxhash64("id"), "id", "text_key").limit(examples)
    sample = candidates.join(F.broadcast(rows), ["id", "text_key"]).dropDuplicates(["id", "text_key"]).drop("text_key").persist()
    totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    positive, negative = totals.get(1, 0), totals.get(0, 0)
    n = positive + negative
    terms: list[str] = []
    if positive and negative:
        held = sample.select("label", "text").mapInArrow(_distinct_terms, "label int, term string").groupBy("term").agg(
            F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
        cross = F.col("a") * (negative - F.col("b")) - F.col("b") * (positive - F.col("a"))
        rest = (F.col("a") + F.col("b")) * (n - F.col("a") - F.col("b"))
        phi = F.when(rest > 0, cross.cast("double") * cross / (rest.cast("double") * positive * negative)).otherwise(0.0)
        telling = held.filter((F.col("a") + F.col("b") >= LEAST_EXAMPLES) & (phi >= PHI_SQUARE))
        terms = sorted(r["term"] for r in telling.select("term").collect())
    place = {t: i for i, t in enumerate(terms)}

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted, total, places = Counter(), 0, _Places(place)
        for batch in row_batches(batches):
            for text in batch.column("text").to_pylist():
                total += 1
                counted.update({t for w in words_of(text) for t in places[w]})
        yield pa.record_batch([pa.array([-1, *counted], pa.int32()), pa.array([total, *counted.values()], pa.int64())], names=["term", "n"])

    def uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _Places(place)
        for batch in row_batches(batches):
            found = [sorted(Counter(t for w in words_of(text) for t in places[w]).items()) for text in batch.column("text").to_pylist()]
            yield pa.record_batch([
                batch.column("id"), batch.column("label"), pa.array([[t for t, _ in f] for f in found], pa.list_(pa.int32())),
                pa.array([[c for _, c in f] for f in found], pa.list_(pa.int32()))], names=["id", "label", "terms", "counts"])

    if not terms:
        sample.unpersist()
        return Index([], np.zeros(0), [], np.zeros(0), [], (n, positive))
    counted = docs.select(text_of(text_column).alias("text")).mapInArrow(frequencies, "term int, n long") \
        .groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {r["term"]: r["n"] for r in counted}
    idf = np.array([np.log((found.get(-1, 0) + 1.0) / (found.get(i, 0) + 1.0)) + 1.0 for i in range(len(terms))])
    # uses by example: at most ``examples`` times the indexed terms of a text
    kind = docs.schema[id_column].dataType.simpleString()
    rows = sample.mapInArrow(uses, f"id {kind}, label int, terms array<int>, counts array<int>").collect()
    sample.unpersist()
    speaking = sorted((r for r in rows if r["terms"]), key=lambda r: (r["id"], r["terms"], r["counts"]))
    silent = [r for r in rows if not r["terms"]]
    return Index(terms, idf, [r["id"] for r in speaking], np.array([r["label"] for r in speaking], float),
                 [dict(zip(r["terms"], r["counts"], strict=True)) for r in speaking], (len(silent), sum(r["label"] for r in silent)))


def _distinct_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in row_batches(batches, rows=200):
        labels, terms = [], []
        for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
            found = {t for w in set(words_of(text)) for t in terms_of(w)}
            terms += found
            labels += [label] * len(found)
        yield pa.record_batch([pa.array(labels, pa.int32()), pa.array(terms, pa.string())], names=["label", "term"])


def score(docs: DataFrame, index: Index, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, score, predicted, evidence) for every row of ``docs``, from its whole text.

    ``evidence`` lists the neighbours: example id, similarity, label.  A text without an indexed term (an empty
    or null one too) has no neighbour and gets the rate of toxic examples among those without one.  Ties between
    examples go to the smaller id.  Very long texts are read whole; repeated rows and null ids come through; an
    empty table gives an empty one; without usable labels the score is the share of toxic ones, 0 if there are none.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(index)
    entry = pa.struct([("example", pa.string()), ("similarity", pa.float64()), ("label", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for batch in row_batches(batches):
            found = [held.score(words_of(t)) for t in batch.column("text").to_pylist()]
            evidence = [[{"example": str(held.ids[e]), "similarity": s, "label": int(held.labels[e])} for s, e in near] for _, near in found]
            yield pa.record_batch([
                batch.column("id"), pa.array([s for s, _ in found], pa.float64()), pa.array([int(s >= 0.5) for s, _ in found], pa.int32()),
                pa.array(evidence, pa.list_(entry))], names=["id", "score", "predicted", "evidence"])

    return in_small_batches(docs).select(F.col(id_column).alias("id"), text_of(text_column).alias("text")).mapInArrow(
        run, f"id {kind}, score double, predicted int, evidence array<struct<example: string, similarity: double, label: int>>")


def held_out(id_column: str = "doc_id") -> Column:
    """Documents whose labels nothing is learned from."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def classify(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fit on the labels that are not held out and score all documents."""
    return score(docs, fit(docs, labels.filter(~held_out(id_column)), id_column, text_column), id_column, text_column)
