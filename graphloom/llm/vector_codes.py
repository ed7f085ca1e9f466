"""Vector code compression: product quantisation in integers with adaptive distance bounds.

Vectors become integers, are cut into equal parts, and each part position has a codebook that is fitted by a fixed
number of rounds of assigning and averaging.  All arithmetic is exact, so the codes do not depend on how rows are spread.

After Drake and Hamerly, every part keeps an upper bound of the distance to its entry, the b next closest entries with
ordered lower bounds, and one outer bound for all others; they are written with the row after each round.  When the
entries move, bounds shift by the way each entry went.  A part whose upper bound stays strictly below its first lower
bound keeps its entry unseen; otherwise its entry and the b candidates, or all entries if the outer bound is reached too,
are compared by integer squared distances.  b follows what the last round needed.

A round is one pass without a shuffle: tasks write rows with their bounds, and one row of sums each, which are added up to
one number for every component of the codebooks.  Only codebooks are on the driver and in the tasks' code.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import in_small_batches, row_batches
from graphloom.session import cut, discard

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: share of the parts whose needed candidates b is chosen to hold
COVERED = 0.95
_STATE = "id {id}, label {label}, v binary, codes binary, near binary, low binary, edge binary, stats array<bigint>"


@dataclass(frozen=True)
class Books:
    """Codebooks by part, entry and position, in integers: component x stands for floor(scale * x)."""

    entries: tuple[tuple[tuple[int, ...], ...], ...]

    @property
    def array(self) -> np.ndarray:
        return np.array(self.entries, np.int64).reshape(len(self.entries), len(self.entries[0]) if self.entries else 0, -1)

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for part in self.entries for entry in part for x in entry).encode()).hexdigest()


def _root(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Integer square roots, rounded down and up."""
    down = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    down -= down * down > squares
    down += (down + 1) * (down + 1) <= squares
    return down, down + (down * down < squares)


def _squares(part: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of n parts to m entries each, or to the same m entries."""
    gap = part[:, None, :] - entries
    return np.einsum("nmk,nmk->nm", gap, gap)


@dataclass
class Bounds:
    """Of n parts: entry, upper bound, next closest entries, their ordered lower bounds, outer bound."""

    code: np.ndarray
    up: np.ndarray
    near: np.ndarray
    low: np.ndarray
    outer: np.ndarray


def _closest(squares: np.ndarray, entries: np.ndarray, b: int) -> Bounds:
    """Bounds from exact squared distances to the given entries (ascending in each row); the outer one from them alone."""
    order = np.argsort(squares, axis=1, kind="stable")  # of equal distances the lower index
    ranked = np.take_along_axis(squares, order, 1)
    names = np.take_along_axis(np.broadcast_to(entries, squares.shape), order, 1)
    down, up = _root(ranked)
    far = down[:, b + 1] if down.shape[1] > b + 1 else np.full(len(down), np.int64(1) << 40)
    return Bounds(names[:, 0], up[:, 0], names[:, 1:b + 1], down[:, 1:b + 1], far)


def reassign(part: np.ndarray, book: np.ndarray, drift: np.ndarray, held: Bounds, b: int) -> tuple[Bounds, np.ndarray]:
    """Bounds after the entries moved by at most ``drift``, with b candidates, and how many candidates each part needed."""
    n, kept = held.near.shape
    everything = np.arange(len(book))
    up = held.up + drift[held.code]
    low = np.maximum(held.low - drift[held.near], 0)
    outer = np.maximum(held.outer - drift.max(initial=0), 0)
    if kept:
        low[:, -1] = np.minimum(low[:, -1], outer)
        low = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1]
    need = (up[:, None] >= low).sum(axis=1) + (up >= outer)  # 0: certain; more than kept: all entries are compared
    out = Bounds(held.code.copy(), up, np.zeros((n, b), np.int64), np.zeros((n, b), np.int64), outer)
    same = min(b, kept)
    out.near[:, :same], out.low[:, :same] = held.near[:, :same], low[:, :same]
    if b < kept:  # what is no longer listed is bounded by the outer bound
        out.outer = np.minimum(outer, low[:, b])
    certain = need == 0
    some = ~certain & (need <= kept) & (b <= kept)
    rows = np.flatnonzero(some)
    if len(rows):
        asked = np.sort(np.concatenate((held.code[rows, None], held.near[rows]), axis=1), axis=1)
        fresh = _closest(_squares(part[rows], book[asked]), asked, b)
        out.code[rows], out.up[rows], out.near[rows], out.low[rows] = fresh.code, fresh.up, fresh.near, fresh.low
        out.outer[rows] = np.minimum(fresh.outer, outer[rows])
        out.low[rows] = np.minimum(out.low[rows], out.outer[rows, None])
    # a longer list than was kept can only be filled from all entries
    rows = np.flatnonzero((need > kept) | (b > kept))
    if len(rows):
        fresh = _closest(_squares(part[rows], book[None]), everything, b)
        out.code[rows], out.up[rows], out.near[rows], out.low[rows], out.outer[rows] = fresh.code, fresh.up, fresh.near, fresh.low, fresh.outer
    return out, need


def _binary(block: np.ndarray) -> pa.Array:
    """One binary value for every row of a block."""
    width, raw = block[0].nbytes if len(block) else 0, np.ascontiguousarray(block).tobytes()
    ends = pa.array(np.arange(len(block) + 1, dtype=np.int32) * width)
    return pa.Array.from_buffers(pa.binary(), len(block), [None, ends.buffers()[1], pa.py_buffer(raw)])


def _block(column: pa.Array, kind: str, *shape: int) -> np.ndarray:
    """The rows of a binary column of one width."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape)


def _types(reach: int) -> tuple[str, str]:
    """Narrow types that hold all components, and all distances between vectors and entries."""
    return ("<i2" if reach < 1 << 15 else "<i4"), ("<u2" if 8 * reach * reach < 1 << 28 else "<u4")


def _pass(schema: pa.Schema, book: np.ndarray, drift: np.ndarray | None, b: int, kept: int, kinds: tuple[str, str], limit: int):
    """One round over rows with (old) bounds: rows with new ones, then one row of sums."""
    parts, entries, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        needs, seen = np.zeros(entries + 1, np.int64), False
        for batch in row_batches(batches, rows=8192, size=4 << 20):
            n, seen = batch.num_rows, True
            v = _block(batch.column("v"), kinds[0], parts, width).astype(np.int64)
            codes, near = np.zeros((n, parts), np.uint8), np.zeros((n, parts, b), np.uint8)
            low, edge = np.zeros((n, parts, b), kinds[1]), np.zeros((n, parts, 2), kinds[1])
            if drift is not None:
                old = {c: _block(batch.column(c), k, *s) for c, k, s in (
                    ("codes", "u1", (parts,)), ("near", "u1", (parts, kept)), ("low", kinds[1], (parts, kept)), ("edge", kinds[1], (parts, 2)))}
            for p in range(parts):
                if drift is None:
                    new, need = _closest(_squares(v[:, p], book[p][None]), np.arange(entries), b), np.full(n, entries)
                else:
                    held = Bounds(old["codes"][:, p].astype(np.int64), old["edge"][:, p, 0].astype(np.int64), old["near"][:, p].astype(np.int64),
                                  old["low"][:, p].astype(np.int64), old["edge"][:, p, 1].astype(np.int64))
                    new, need = reassign(v[:, p], book[p], drift[p], held, b)
                codes[:, p], near[:, p], low[:, p] = new.code, new.near, np.minimum(new.low, limit)
                edge[:, p, 0], edge[:, p, 1] = np.minimum(new.up, limit), np.minimum(new.outer, limit)
                needs += np.bincount(np.minimum(need, entries), minlength=entries + 1)
                counts[p] += np.bincount(new.code, minlength=entries)
                np.add.at(sums[p], new.code, v[:, p])
            yield pa.record_batch([batch.column("id"), batch.column("label"), batch.column("v"), *map(_binary, (codes, near, low, edge)),
                                   pa.nulls(n, pa.list_(pa.int64()))], schema=schema)
        if seen:
            stats = np.concatenate((sums.ravel(), counts.ravel(), needs)).tolist()
            yield pa.record_batch([pa.nulls(1, f.type) for f in list(schema)[:-1]] + [pa.array([stats], pa.list_(pa.int64()))], schema=schema)

    return run


def _final(schema: pa.Schema, book: np.ndarray, drift: np.ndarray, kept: int, kinds: tuple[str, str]):
    """The last assignment: code and exact error of every row."""
    parts, _, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_batches(batches, rows=8192, size=4 << 20):
            v = _block(batch.column("v"), kinds[0], parts, width).astype(np.int64)
            edge, near = _block(batch.column("edge"), kinds[1], parts, 2).astype(np.int64), _block(batch.column("near"), "u1", parts, kept).astype(np.int64)
            low, codes = _block(batch.column("low"), kinds[1], parts, kept).astype(np.int64), _block(batch.column("codes"), "u1", parts).astype(np.int64)
            error, found = np.zeros(batch.num_rows, np.int64), np.zeros(codes.shape, np.uint8)
            for p in range(parts):
                new, _ = reassign(v[:, p], book[p], drift[p], Bounds(codes[:, p], edge[:, p, 0], near[:, p], low[:, p], edge[:, p, 1]), kept)
                found[:, p] = new.code
                error += _squares(v[:, p], book[p][new.code][:, None, :])[:, 0]
            yield pa.record_batch([batch.column("id"), batch.column("label"), pa.array([c.tobytes().hex() for c in found]), pa.array(error)], schema=schema)

    return run


def _integers(schema: pa.Schema, kind: str, scale: int):
    """floor(scale * x) of every component, as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_batches(batches, rows=8192, size=4 << 20):
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            whole = np.floor(flat * scale).astype(kind).reshape(batch.num_rows, -1)
            yield pa.record_batch([batch.column("id"), batch.column("label"), _binary(whole)], schema=schema)

    return run


def fit_codes(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
              parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[Books, DataFrame]:
    """Codebooks, and (id, label, code, error) of every vector: two hex digits a part, exact squared distances summed.

    Rows whose vector is null or holds a null or non-finite component are left out.  Codebooks start from the
    vectors of the smallest ids (null ids last, equal ids by their vectors); with fewer vectors than ``entries`` they are
    shorter.  Repeated rows count as often as they stand there.  No vector gives an empty table and empty codebooks.
    Vectors of different lengths, a length that ``parts`` does not divide, and components so large that a squared
    distance exceeds 63 bits are a ValueError.
    """
    if not 1 <= entries <= 256:
        raise ValueError("codes are two hex digits: 1 to 256 entries")
    spark = vectors.sparkSession
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = in_small_batches(vectors).select(F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.col(vector_column).cast("array<double>").alias("v")).filter(F.col("v").isNotNull()).filter(sound)
    facts = rows.agg(F.count("*").alias("n"), F.min(F.size("v")).alias("short"), F.max(F.size("v")).alias("long"),
                     F.max(F.greatest(F.array_max("v"), -F.array_min("v"))).alias("reach")).first()
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("id", "label")}
    if not facts["n"]:
        return Books(()), spark.createDataFrame([], f"id {kinds['id']}, label {kinds['label']}, code string, error bigint")
    size, reach = facts["long"], math.ceil((facts["reach"] or 0.0) * scale) + 1
    if facts["short"] != size or size % parts:
        raise ValueError(f"vectors of {facts['short']} to {size} components cannot be cut into {parts} equal parts")
    if max(1, size) * (2 * reach) ** 2 >= 1 << 63:
        raise ValueError("components are too large for squared distances of 63 bits")
    width = size // parts
    narrow = _types(reach) if width <= 8 else (_types(reach)[0], "<u4")
    limit = int(np.iinfo(narrow[1]).max)
    seeds = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    first = [[math.floor(scale * x) for x in s["v"]] for s in seeds]
    book = [[tuple(f[p * width:(p + 1) * width]) for f in first] for p in range(parts)]
    held = len(first)

    whole = _arrow(f"id {kinds['id']}, label {kinds['label']}, v binary")
    state = cut(rows.mapInArrow(_integers(whole, narrow[0], scale), f"id {kinds['id']}, label {kinds['label']}, v binary"))
    layout = _STATE.format(**kinds)
    least, most = max(1, min(held - 1, entries // 8)), max(1, min(held - 1, entries // 2))
    b = kept = 0 if held == 1 else max(least, min(most, entries // 4))
    drift = None
    for _ in range(rounds):
        before = state
        run = _pass(_arrow(layout), Books(tuple(map(tuple, book))).array, drift, b, kept, narrow, limit)
        columns = ["id", "label", "v"] if drift is None else ["id", "label", "v", "codes", "near", "low", "edge"]
        state = cut(before.filter(F.col("v").isNotNull()).select(*columns).mapInArrow(run, layout))
        discard([before])
        # one number for every component, entry and count: bounded by the codebooks
        total = state.filter(F.col("stats").isNotNull()).select(F.posexplode("stats").alias("at", "value")).groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
        numbers = dict.fromkeys(range(parts * held * (width + 1) + held + 1), 0) | {r["at"]: int(r["value"]) for r in total}
        after = [[tuple(
            numbers[(p * held + e) * width + i] // numbers[parts * held * width + p * held + e] for i in range(width)
        ) if numbers[parts * held * width + p * held + e] else book[p][e] for e in range(held)] for p in range(parts)]
        drift = np.array([[_up(sum((x - y) ** 2 for x, y in zip(old, new, strict=True))) for old, new in zip(*books, strict=True)]
                          for books in zip(book, after, strict=True)], np.int64).reshape(parts, held)
        needed = [numbers[parts * held * (width + 1) + z] for z in range(held + 1)]
        book, kept = after, b
        if held > 1:
            b = max(least, min(most, _covering(needed, b)))
    books = Books(tuple(map(tuple, book)))
    out = f"id {kinds['id']}, label {kinds['label']}, code string, error bigint"
    if drift is None:  # no round: the first entries are the codebooks
        run = _pass(_arrow(layout), books.array, None, b, b, narrow, limit)
        state, drift = cut(state.mapInArrow(run, layout)), np.zeros((parts, held), np.int64)
    coded = cut(state.filter(F.col("v").isNotNull()).select("id", "label", "v", "codes", "near", "low", "edge").mapInArrow(_final(_arrow(out), books.array, drift, kept, narrow), out))
    discard([state])
    return books, coded


def _up(square: int) -> int:
    root = math.isqrt(square)
    return root + (root * root < square)


def _covering(needed: list[int], b: int) -> int:
    """Candidates that were enough for ``COVERED`` of the parts; where even all b kept were too few, more."""
    upto, total = 0, sum(needed)
    for z, n in enumerate(needed):
        upto += n
        if upto >= COVERED * total:
            return z if z <= b else 2 * b
    return b


def _arrow(layout: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(layout))


def compress(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", **options: int) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) of every vector; edge cases as in ``fit_codes``.

    ``label_error`` is the error summed over all rows of the same label, null labels together.
    """
    books, coded = fit_codes(vectors, id_column, vector_column, label_column, **options)
    totals = cut(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "id", "label", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))


def approximate(coded: DataFrame, books: Books, scale: int = SCALE) -> DataFrame:
    """(id, vector array<double>) that the codes stand for; a null code gives a null vector."""
    entries = [[[float(x) / scale for x in entry] for entry in part] for part in books.entries]
    kind = coded.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [None if c is None else [x for p, e in enumerate(bytes.fromhex(c)) for x in entries[p][e]] for c in batch.column("code").to_pylist()]
            yield pa.record_batch([batch.column("id"), pa.array(rows, pa.list_(pa.float64()))], names=["id", "vector"])

    return in_small_batches(coded).select("id", "code").mapInArrow(run, f"id {kind}, vector array<double>")
