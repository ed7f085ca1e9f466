"""Similarity join on word five-grams with Bayesian candidate pruning.

Texts with the same set of five-grams are folded first.  MinHash bands propose pairs of different sets; the
values of a pair are compared sixteen at a time, and it is dropped once the posterior probability (uniform
prior) that its similarity reaches the threshold is below ``TOLERANCE``.  What survives is verified on the whole
five-gram sets.  Pairs are never rows: the rows of a band are dealt to cells of at most two blocks, a cell hands
on one link per member of what hangs together in it, and the sets of one candidate component then meet in
such cells again to be verified and counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.graph import Graph
from graphloom.llm.common import document_key, fresh, in_small_batches, row_batches, text_of
from graphloom.llm.wordhash import hashes, mixed, run_hashes
from graphloom.operators.components import connected_components
from graphloom.session import cut

SHINGLE, THRESHOLD = 5, 0.8
#: a pair at the threshold is missed by all bands with probability (1 - 0.8 ** 3) ** 21 < 3e-7
BANDS, ROWS = 21, 3
VALUES, STEP = 64, 16
TOLERANCE = 1e-7
#: sets in one block; a cell holds one block or two
BLOCK = 256

_LOWER_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SALT = mixed(np.arange(1, VALUES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingles(text: str) -> np.ndarray:
    """Sorted hashes of the distinct five-grams of lower-cased words; a text under five words is one gram."""
    words = text.lower().encode("utf-8", "replace").translate(_LOWER_WORDS).split()
    return np.unique(run_hashes(hashes(words), min(SHINGLE, len(words)))) if words else np.zeros(0, np.uint64)


def minhash(grams: np.ndarray) -> np.ndarray:
    """``VALUES`` minima, each under a hash function of its own."""
    return np.array([mixed(grams ^ s).min() for s in _SALT]) if len(grams) > 4096 else mixed(grams[:, None] ^ _SALT[None, :]).min(axis=0)


def least_agreements(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For each number of values compared, the fewest agreements with which a pair goes on.

    Under a uniform prior, P(similarity >= t | m of n agree) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


_LEAST = least_agreements()


def surviving(values: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (left[k], right[l]) that neither their sizes nor their values rule out, each unordered pair once."""
    a, b = np.meshgrid(left, right, indexing="ij")
    a, b = a.ravel(), b.ravel()
    low, high = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
    may = (a < b if left is right else a != b) & (low >= THRESHOLD * high - 1e-9)
    a, b = a[may], b[may]
    same = np.zeros(len(a), np.int64)
    for step, least in enumerate(_LEAST):
        part = slice(step * STEP, (step + 1) * STEP)
        same += (values[a, part] == values[b, part]).sum(axis=1)
        on = same >= least
        a, b, same = a[on], b[on], same[on]
    return a, b


def joined(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of what each of ``count`` members hangs together with."""
    name = np.arange(count)
    while len(a):
        least = np.minimum(name[a], name[b])
        new = name.copy()
        np.minimum.at(new, name[a], least)
        np.minimum.at(new, name[b], least)
        new = new[new]
        if (new[name] == name).all():
            break
        name = new[name]
    return name


def similar(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs (a, b) of sets have a Jaccard similarity of at least the threshold."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = uses[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        low, high = np.searchsorted(column, (start, start + width))
        part = np.zeros((len(sets), width), np.float32)
        part[owner[low:high], column[low:high] - start] = 1.0
        common += part @ part.T
    both = common[a, b].astype(np.int64)
    return 5 * both >= 4 * (sizes[a] + sizes[b] - both)


_SKETCH = "set_id binary, n int, bands array<long>, sketch binary"


def sketches(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, text_key, set_id, n, bands, sketch); the set's id is null where a text has no word."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_batches(batches):
            names, sizes, bands, sketch = [], [], [], []
            for text in batch.column("text").to_pylist():
                grams = shingles(text)
                sizes.append(len(grams))
                if not len(grams):
                    names.append(None)
                    bands.append(None)
                    sketch.append(None)
                    continue
                least = minhash(grams)
                names.append(np.array([grams.sum(), mixed(grams).sum()], np.uint64).tobytes())
                groups = least[:BANDS * ROWS].reshape(BANDS, ROWS)
                bands.append(mixed(groups[:, 0] + mixed(groups[:, 1] + mixed(groups[:, 2] + np.arange(BANDS, dtype=np.uint64)))).view(np.int64).tolist())
                sketch.append((least >> np.uint64(48)).astype("<u2").tobytes())
            yield pa.record_batch([
                batch.column("id"), batch.column("text_key"), pa.array(names, pa.binary()), pa.array(sizes, pa.int32()),
                pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                names=["id", "text_key", "set_id", "n", "bands", "sketch"])

    rows = in_small_batches(docs).select(*document_key(id_column, text_column), text_of(text_column).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, text_key long, {_SKETCH}")


def _cells(rows: DataFrame, group: str, count: str) -> DataFrame:
    """Deal the members of each group to cells of one block or two: a group of g rows makes (g / BLOCK)^2 / 2 cells.

    Adds ``cell``, ``whole`` (the group) and ``side`` (0 and 1, or 2 where a cell is one block by itself).
    """
    blocks = F.ceil(F.col(count) / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("set_id", F.lit(1)), blocks).cast("int")
    dealt = rows.withColumn("_mine", mine).withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    cell = F.xxhash64(group, F.least("_mine", "_other"), F.greatest("_mine", "_other"))
    side = F.when(F.col("_mine") == F.col("_other"), 2).when(F.col("_mine") < F.col("_other"), 0).otherwise(1)
    # block pairs meet once for each member of either block; a block alone is a cell of its own
    return dealt.withColumn("cell", cell).withColumn("side", side.cast("int")).withColumn("whole", F.col(group)).drop("_mine", "_other")


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one cell after the other, from rows sorted by cell and group.

    Members come by their id, so what hangs together is named by its smallest id: the cells that a group has in
    many bands then name the same links, and few of them are left to follow.
    """
    by_id = itemgetter("set_id")
    held: list[dict] = []
    for batch in row_batches(batches):
        for row in batch.to_pylist():
            if held and (held[-1]["cell"], held[-1]["whole"]) != (row["cell"], row["whole"]):
                yield sorted(held, key=by_id)
                held = []
            held.append(row)
    if held:
        yield sorted(held, key=by_id)


def _sides(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    side = np.array([r["side"] for r in rows])
    if (side == 2).all():
        alone = np.arange(len(rows))
        return alone, alone
    return np.flatnonzero(side == 0), np.flatnonzero(side == 1)


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of a band -> links between members that hang together by surviving pairs."""
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        links = list(set(out))
        return pa.record_batch([pa.array([x[0] for x in links], pa.binary()), pa.array([x[1] for x in links], pa.binary())], names=["src", "dst"])

    for rows in _by_cell(batches):
        if len(rows) < 2:
            continue
        values = np.frombuffer(b"".join(r["sketch"] for r in rows), "<u2").reshape(len(rows), VALUES)
        a, b = surviving(values, np.array([r["n"] for r in rows]), *_sides(rows))
        name = joined(len(rows), a, b)
        out += [(rows[k]["set_id"], rows[i]["set_id"]) for i, k in enumerate(name.tolist()) if i != k]
        if len(out) > 20_000:
            yield flush()
            out.clear()
    yield flush()


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of a candidate component -> (set_id, head, links): links counts the documents of linked sets."""
    for rows in _by_cell(batches):
        sets = [shingles(r["text"]) for r in rows]
        values = np.array([minhash(s) >> np.uint64(48) for s in sets]).reshape(len(rows), VALUES)
        a, b = surviving(values, np.array([len(s) for s in sets]), *_sides(rows))
        if not len(a):
            continue
        good = similar(sets, a, b)
        a, b = a[good], b[good]
        copies = np.array([r["copies"] for r in rows], np.int64)
        links = np.zeros(len(rows), np.int64)
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        name = joined(len(rows), a, b)
        found = np.flatnonzero(links)
        yield pa.record_batch([
            pa.array([rows[i]["set_id"] for i in found], pa.binary()), pa.array([rows[name[i]]["set_id"] for i in found], pa.binary()),
            pa.array(links[found])], names=["set_id", "head", "links"])


def _components(links: DataFrame) -> DataFrame:
    """(set_id, component) of every set with a link."""
    links = cut(links)
    ends = links.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    found = connected_components(Graph(ends.withColumn("type", F.lit("set")), links.withColumn("relationship", F.lit("similar"))))
    return cut(found.withColumnRenamed("id", "set_id"))


def similar_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, text_key, class_id, n_links, kept.

    Two documents are linked when the Jaccard similarity of their sets of lower-cased word five-grams is 0.8 or
    more; ``n_links`` counts the other rows linked to this one, ``class_id`` is the smallest id (nulls last) of
    the rows that hang together with it, ``kept`` marks its row.  A text of one to four words is one gram; one without a word, null or
    empty is linked to nothing and is its own class.  Repeated rows are links of each other.  Very long texts
    take part with all their grams.  An empty table gives an empty one; other columns play no part.
    """
    rows = cut(sketches(docs, id_column, text_column))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key")).alias("first")
    sets = cut(rows.filter("set_id is not null").groupBy("set_id").agg(
        F.count("*").alias("copies"), first, F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))

    # candidate links: only bands that two sets share go on
    banded = sets.select("set_id", F.explode("bands").alias("band"))
    shared = cut(banded.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1"))
    met = banded.join(shared, "band")
    dealt = _cells(met, "band", "members").join(sets.select("set_id", "n", "sketch"), "set_id")
    proposed = dealt.select("cell", "whole", "side", "set_id", "n", "sketch").repartition("cell").sortWithinPartitions("cell", "whole") \
        .mapInArrow(_propose, "src binary, dst binary").distinct()
    near = _components(proposed)

    # verification inside each candidate component, on whole texts
    sizes = near.groupBy("component").agg(F.count("*").alias("members"))
    members = near.join(cut(sizes), "component").join(sets.select("set_id", "copies", "first.id", "first.text_key"), "set_id")
    texts = docs.select(*document_key(id_column, text_column), text_of(text_column).alias("text"))
    texts = texts.withColumnsRenamed({"id": "t_id", "text_key": "t_key"})
    same = F.col("id").eqNullSafe(F.col("t_id")) & (F.col("text_key") == F.col("t_key"))
    # rows that repeat id and text give the same text twice
    told = texts.join(members.select("set_id", "component", "members", "copies", "id", "text_key"), same).dropDuplicates(["set_id"])
    checked = cut(
        _cells(told, "component", "members").select("cell", "whole", "side", "set_id", "copies", "text")
        .repartition("cell").sortWithinPartitions("cell", "whole").mapInArrow(_verify, "set_id binary, head binary, links long"))
    classes = _components(checked.filter("set_id <> head").select(F.col("head").alias("src"), F.col("set_id").alias("dst")).distinct())
    links = checked.groupBy("set_id").agg(F.sum("links").alias("links"))

    placed = sets.select("set_id", "copies", "first").join(classes, "set_id", "left").join(links, "set_id", "left") \
        .withColumn("component", F.coalesce("component", "set_id"))
    least = placed.groupBy("component").agg(F.min("first").alias("least"))
    # written, so that the join below can split the rows of a set that a third of all rows share
    answer = cut(placed.join(least, "component").select(
        "set_id", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    alone = F.col("set_id").isNull()
    first_of_class = F.col("id").eqNullSafe(F.col("least.id")) & (F.col("text_key") == F.col("least.text_key"))
    return rows.select("id", "text_key", "set_id").join(answer, "set_id", "left").select(
        "id", "text_key", F.when(alone, F.col("id")).otherwise(F.col("least.id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), (alone | first_of_class).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The first document of every class, with all its columns; rows that repeat id and text stay together."""
    found = similar_documents(docs, id_column, text_column).filter("kept").select(F.col("id").alias("k_id"), F.col("text_key").alias("k_key"))
    id_name, key_name = fresh("id"), fresh("key")
    found = found.withColumnsRenamed({"k_id": id_name, "k_key": key_name})
    same = F.col(id_column).eqNullSafe(F.col(id_name)) & (F.xxhash64(text_of(text_column)) == F.col(key_name))
    return docs.join(found, same, "left_semi")
