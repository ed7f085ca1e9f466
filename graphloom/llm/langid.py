"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary.  A text is scored by the forward
algorithm, which sums over all ways to spell its words with pieces.  Pieces never span words, so the sum over
a text is the product over its words, and a word is scored once per worker.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm import lattice
from graphloom.llm.common import fresh, in_small_batches, row_batches

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: at most so many documents of each language are fitted on, the first by a hash of their id
FIT_DOCUMENTS = 2000
#: rounds of expectation maximisation
ROUNDS = 3
#: pseudo-count of every piece
SMOOTHING = 0.05
#: words whose scores a worker keeps; beyond that it starts anew
CACHE = 250_000
#: words in one lattice
WORDS = 20_000
NONE = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    return _LETTERS.findall(text.lower()) if text else []


def spell(words: list[str]) -> list[bytes]:
    return [f"▁{w}".encode("utf-8", "replace") for w in words]


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in row_batches(batches):
        counts: Counter = Counter()
        for language, text in zip(batch.column("language").to_pylist(), batch.column("text").to_pylist(), strict=True):
            counts.update((language, w) for w in words_of(text))
        keys = list(counts)
        yield pa.record_batch([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                               pa.array(list(counts.values()), pa.int64())], names=["language", "word", "n"])


def fit(docs: DataFrame, language: Column, identity: Column, text_column: str = "text", vocabulary: str = VOCABULARY,
        documents: int = FIT_DOCUMENTS, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """(languages, probability of each piece by language) from labelled documents.

    The sample holds up to ``documents`` texts of each language.  Its word counts stay a table; each round
    sums expected piece counts in tasks, and only these (languages times vocabulary) reach the driver.
    """
    labelled = in_small_batches(docs).select(language.alias("language"), F.col(text_column).alias("text"), identity.alias("pick")) \
        .filter("language is not null and text is not null")
    counts = {r["language"]: r["n"] for r in labelled.groupBy("language").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return [], np.zeros((0, 0))
    # thin by the hash first, so that the ranking below only meets about as many rows as it keeps
    spark = docs.sparkSession
    share = spark.createDataFrame([(k, min(1.0, 1.5 * documents / n + 50 / n)) for k, n in counts.items()], "language string, share double")
    unit = F.pmod("pick", F.lit(1 << 20)) / F.lit(float(1 << 20))
    ranked = Window.partitionBy("language").orderBy("pick", "text")
    sample = labelled.join(F.broadcast(share), "language").filter(unit < F.col("share")) \
        .withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= documents).select("language", "text")
    words = sample.mapInArrow(_word_counts, "language string, word string, n long").groupBy("language", "word") \
        .agg(F.sum("n").alias("n")).persist()

    size = lattice.load(vocabulary).size
    model = np.full((size, len(languages)), 1.0 / size)
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(model)
        expected = words.mapInPandas(_expected(sent, languages, vocabulary), "language int, piece int, n double") \
            .groupBy("language", "piece").agg(F.sum("n").alias("n")).toPandas()
        table = np.full((size, len(languages)), SMOOTHING)
        table[expected["piece"], expected["language"]] += expected["n"]
        model = table / table.sum(axis=0)
    words.unpersist()
    return languages, model


def _expected(sent, languages: list[str], vocabulary: str):
    """Expected counts of pieces under the model of the word's language, by forward and backward sums."""
    place = {name: i for i, name in enumerate(languages)}

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab, model = lattice.load(vocabulary), sent.value
        sums = np.zeros_like(model)
        for frame in frames:
            for name, part in frame.groupby("language", sort=True):
                weights = model[:, [place[name]]]
                for low in range(0, len(part), WORDS):
                    piece = part.iloc[low:low + WORDS]
                    net = lattice.Lattice(vocab, spell(piece["word"].tolist()))
                    np.add.at(sums[:, place[name]], *posterior(net, weights, piece["n"].to_numpy(float)))
        pieces, columns = np.nonzero(sums)
        yield pd.DataFrame({"language": columns, "piece": pieces, "n": sums[pieces, columns]})

    return count


#: words under so many bytes, and of at least this scaled probability, are summed without logarithms
PLAIN_BYTES, PLAIN_LEAST = 64, 1e-200


def posterior(net: lattice.Lattice, weights: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(piece, expected uses) of every arc, given how often each text occurs."""
    _, reach, _ = lattice.forward(net, weights, PLAIN_BYTES)
    left = np.zeros(net.positions)
    left[net.final] = 1.0
    for group in reversed(net.by_end_and_length()):
        gain = weights[net.piece[group], 0] * lattice.PER_BYTE ** float(net.length[group.start])
        np.add.at(left, net.start[group], left[net.end[group]] * gain)
    total = reach[net.final, 0]
    gain = weights[net.piece, 0] * lattice.PER_BYTE ** net.length.astype(float)
    short = (net.sizes < PLAIN_BYTES) & (total >= PLAIN_LEAST)
    part = np.where(short, times / np.where(short, total, 1.0), 0.0)
    with np.errstate(invalid="ignore", over="ignore"):
        uses = np.where(short[net.text], reach[net.start, 0] * gain * left[net.end] * part[net.text], 0.0)
    if not short.all():
        hard = ~short[net.text]
        uses[hard] = _log_posterior(net, weights, times, hard)
    return net.piece, uses


def _log_posterior(net: lattice.Lattice, weights: np.ndarray, times: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Expected uses of the chosen arcs, all arcs of some texts, by sums of logarithms, which no length makes vanish."""
    arcs = np.flatnonzero(chosen)
    with np.errstate(divide="ignore"):
        gain = np.log(weights[net.piece, 0])
    reach, left = np.full(net.positions, -np.inf), np.full(net.positions, -np.inf)
    reach[net.first], left[net.final] = 0.0, 0.0
    # in a group neither two starts nor two ends agree
    groups = [arcs[low:high] for group in net.by_end_and_length()
              for low, high in [np.searchsorted(arcs, (group.start, group.stop))] if high > low]
    for g in groups:
        reach[net.end[g]] = np.logaddexp(reach[net.end[g]], reach[net.start[g]] + gain[g])
    for g in reversed(groups):
        left[net.start[g]] = np.logaddexp(left[net.start[g]], left[net.end[g]] + gain[g])
    total = reach[net.final][net.text[arcs]]
    return np.exp(reach[net.start[arcs]] + gain[arcs] + left[net.end[arcs]] - total) * times[net.text[arcs]]


class Scorer:
    """Log probability of words by language, kept between batches of one worker."""

    def __init__(self, model: np.ndarray, vocabulary: str) -> None:
        self.vocab, self.model = lattice.load(vocabulary), model
        self.row: dict[str, int] = {}
        self.scores = np.zeros((0, model.shape[1]))

    def learn(self, words: list[str]) -> None:
        if len(self.row) + len(words) > CACHE:
            self.row.clear()
            self.scores = np.zeros((0, self.model.shape[1]))
        new = [self.scores]
        words.sort(key=len)
        for low in range(0, len(words), WORDS):
            part = words[low:low + WORDS]
            new.append(lattice.forward(lattice.Lattice(self.vocab, spell(part)), self.model)[0])
            self.row.update(zip(part, range(len(self.row), len(self.row) + len(part)), strict=True))
        self.scores = np.concatenate(new)

    def texts(self, texts: list[str | None]) -> np.ndarray:
        split = [words_of(t) for t in texts]
        missing = list({w for words in split for w in words}.difference(self.row))
        if missing and len(self.row) + len(missing) > CACHE:
            missing = list({w for words in split for w in words})
        if missing:
            self.learn(missing)
        row = self.row
        flat = np.fromiter((row[w] for words in split for w in words), np.int64)
        sizes = np.array([len(words) for words in split], np.int64)
        # each text is summed by itself
        sums, some = np.zeros((len(split), self.scores.shape[1])), sizes > 0
        if some.any():
            sums[some] = np.add.reduceat(self.scores[flat], (np.cumsum(sizes) - sizes)[some], axis=0)
        return sums


_SCORERS: dict[str, Scorer] = {}


def with_language(docs: DataFrame, languages: list[str], model: np.ndarray, text_column: str = "text",
                  vocabulary: str = VOCABULARY, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with two columns more: predicted language and score; see ``predict``.

    ``names`` are those of the new columns; they must not be columns of ``docs``.
    """
    sent, scorer = docs.sparkSession.sparkContext.broadcast(model), fresh("scorer")
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if scorer not in _SCORERS and languages:
            _SCORERS.clear()
            _SCORERS[scorer] = Scorer(sent.value, vocabulary)
        for batch in row_batches(batches):
            texts = batch.column(text_column).to_pylist()
            found, scores = [NONE] * len(texts), [0.0] * len(texts)
            if languages:
                sums = _SCORERS[scorer].texts(texts)
                best = sums.argmax(axis=1)
                share = 1.0 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                for i, text in enumerate(texts):
                    if text and _LETTERS.search(text):
                        found[i], scores[i] = languages[best[i]], float(share[i])
            yield pa.record_batch([*[batch.column(c) for c in columns], pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                                  names=[*columns, *names])

    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return in_small_batches(docs).mapInArrow(run, schema)


def predict(docs: DataFrame, languages: list[str], model: np.ndarray, id_column: str = "doc_id", text_column: str = "text",
            vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, lang_pred, score) for every row of ``docs``, from its whole text.

    ``score`` is the posterior of the predicted language under equal priors.  A text that is null or has no
    letter is ``und`` with score 0, as is every text when nothing was learned; ties go to the first language
    by name.  Very long texts are split into words like others and scored to the end; repeated rows and null
    ids come through; an empty table gives an empty one; only the named columns are read.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return with_language(rows, languages, model, "text", vocabulary).drop("text")


def held_out(id_column: str = "doc_id") -> Column:
    """Documents that nothing is learned from."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def learn(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", language_column: str = "lang",
          vocabulary: str = VOCABULARY) -> tuple[list[str], np.ndarray]:
    """Fit on the labelled rows that are not held out."""
    return fit(docs.filter(~held_out(id_column)), F.col(language_column), F.xxhash64(id_column), text_column, vocabulary)


def identify(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", language_column: str = "lang",
             vocabulary: str = VOCABULARY) -> DataFrame:
    """Fit on the labelled rows that are not held out and predict all: (id, lang_pred, score)."""
    return predict(docs, *learn(docs, id_column, text_column, language_column, vocabulary), id_column, text_column, vocabulary)


def in_a_language(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", language_column: str = "lang",
                  vocabulary: str = VOCABULARY) -> DataFrame:
    """The rows whose text is in one of the learned languages, with all their columns."""
    names = (fresh("lang"), fresh("score"))
    found = with_language(docs, *learn(docs, id_column, text_column, language_column, vocabulary), text_column, vocabulary, names)
    return found.filter(F.col(names[0]) != NONE).drop(*names)
