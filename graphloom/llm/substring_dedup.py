"""Substring dedup by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words; its minimiser is the run of ``RUN`` words in it with the least hash.
Consecutive windows with the same minimiser (the same place, so no two of them are equal) travel as one packed
string to the bucket of that minimiser.  Equal windows have equal minimisers, so they meet there; the bucket
sorts by minimiser and compares the windows of those that occur twice, word for word.

Before they travel, equal strings of one batch fold into the earliest: the windows of the others start earlier
elsewhere and are removed without going anywhere.  Runs that are common (by a bounded sample of documents) come
last in the order of hashes, so a passage that many documents share does not name a giant bucket; the result
does not depend on that list.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - reached as pa.compute
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import in_small_batches, row_batches, shuffle_partitions, text_of
from graphloom.llm.wordhash import hashes, run_hashes

WINDOW, RUN = 20, 3
#: packed strings of a bucket, in bytes of text; about three times the text is packed
BUCKET_BYTES = 64 << 20
#: documents looked at for common runs, and the part of them that a common run is in
SAMPLE, COMMON = 2000, 0.01
_HIGH = np.uint64(1) << np.uint64(63)


def minimisers(values: np.ndarray, ends: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, minimiser) of each super-k-mer over texts laid end to end.

    ``values``: hashes of all words; ``ends``: where each text ends.
    """
    order = run_hashes(values, RUN) >> np.uint64(1)
    if len(common):
        at = np.minimum(np.searchsorted(common, order), len(common) - 1)
        order = order | np.where(common[at] == order, _HIGH, np.uint64(0))
    starts = np.concatenate(([0], ends[:-1]))
    sizes = np.maximum(ends - starts - WINDOW + 1, 0)
    if not sizes.sum():
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
    window = np.arange(int(sizes.sum())) + shift
    place, least = window.copy(), order[window]
    for shift in range(1, WINDOW - RUN + 1):  # leftmost of the least
        other = order[window + shift]
        smaller = other < least
        least[smaller] = other[smaller]
        place[smaller] = window[smaller] + shift
    breaks = np.flatnonzero(np.diff(place)) + 1
    first = np.concatenate(([0], breaks))
    last = np.concatenate((breaks, [len(place)])) - 1
    return window[first], window[last], order[place[first]]


def _key(value) -> tuple:
    """Order of ids, nulls first."""
    return (0,) if value is None else (1, value)


def _pack(buckets: int, common: np.ndarray):
    """Rows (id, text_key, text) -> rows for buckets; see the schema in ``repeats``."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_batches(batches, rows=1000, size=4 << 20):
            yield pack_one(batch)

    def pack_one(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = {(i, k): t for i, k, t in zip(*[batch.column(c).to_pylist() for c in ("id", "text_key", "text")], strict=True)}  # repeated rows are one document
        keys = sorted(rows, key=lambda k: (_key(k[0]), k[1]))
        split = [rows[k].split() for k in keys]
        ends = np.cumsum([len(w) for w in split])
        words = [w for s in split for w in s]
        first, last, least = minimisers(hashes(words), ends, common)
        text = b" ".join(words)
        offset = np.concatenate(([0], np.cumsum([len(w) + 1 for w in words]))).tolist()
        owner = np.searchsorted(ends, first, side="right")
        start = first - np.concatenate(([0], ends[:-1]))[owner]
        n = last - first + 1
        # fold equal strings: documents come in order, so the first met is the earliest
        met: dict[bytes, int] = {}
        early, later = [], []
        for i, (a, b) in enumerate(zip(first.tolist(), (last + WINDOW).tolist(), strict=True)):
            packed = text[offset[a]:offset[b] - 1]
            if met.setdefault(packed, i) == i:
                early.append(i)
            else:
                later.append(i)
        early, later = np.array(early, np.int64), np.array(later, np.int64)
        strings = list(met)
        # one row per bucket with its strings, and one per document with what is known to be removed
        bucket = (least[early] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        parts = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []
        squeeze = zstandard.ZstdCompressor(level=6)
        blobs = [squeeze.compress(b"\n".join([strings[p] for p in part.tolist()])) for part in parts]
        known = np.split(later, np.flatnonzero(np.diff(owner[later])) + 1) if len(later) else []
        goes = [int(bucket[part[0]]) for part in parts] + [xxhash.xxh3_64_intdigest(repr(keys[owner[part[0]]])) % buckets for part in known]
        members = np.concatenate([early[order], later])
        ends = np.concatenate(([0], np.cumsum([len(p) for p in [*parts, *known]]))).astype(np.int32)
        own = owner[members]

        def lists(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(ends), values)

        # 32 bits of the minimiser are enough to sort by: windows are compared whole
        short = (least[members] >> np.uint64(16)).astype(np.uint32).view(np.int32)
        spans = [np.zeros(0, np.int32)] * len(parts) + [n[p].astype(np.int32) for p in known]

        return pa.record_batch([
            pa.array(goes, pa.int32()), pa.array([*blobs, *[None] * len(known)], pa.binary()),
            lists(pa.array(short)),
            lists(pa.array([k[0] for k in keys], batch.schema.field("id").type).take(pa.array(own))),
            lists(pa.array(np.array([k[1] for k in keys], np.int32)[own] if keys else np.zeros(0, np.int32))),
            lists(pa.array(start[members].astype(np.int32))), pa.array(spans, pa.list_(pa.int32()))],
            names=["bucket", "blob", "minimisers", "ids", "text_keys", "starts", "windows"])

    return pack


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket -> stretches of words to remove: (id, text_key, first, stop); one bucket is in memory at a time."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        bucket = batch.column("bucket").to_numpy()
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for low, high in zip([0, *cuts], [*cuts, len(bucket)], strict=True):
            if held and bucket[low] != current:
                yield from _compare_bucket(held)
                held = []
            current = bucket[low]
            held.append(batch.slice(low, high - low))
    if held:
        yield from _compare_bucket(held)


def _compare_bucket(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blobs: list[bytes] = []  # strings stay packed until one of them can have an equal
    columns: list[list] = [[], [], [], []]
    places: list[np.ndarray] = []
    kind = None
    for batch in batches:
        kind = batch.schema.field("ids").type.value_type
        whole = batch.column("blob").is_valid()
        done, rest = batch.filter(pa.compute.invert(whole)), batch.filter(whole)
        if done.num_rows:
            first = done.column("starts").flatten()
            stop = pa.compute.add(pa.compute.add(first, done.column("windows").flatten()), pa.scalar(WINDOW - 1, pa.int32()))
            yield pa.record_batch([done.column("ids").flatten(), done.column("text_keys").flatten(), first, stop], names=["id", "text_key", "first", "stop"])
        for row, size in enumerate(pa.compute.list_value_length(rest.column("starts")).to_pylist()):
            places.append(np.stack([np.full(size, len(blobs), np.int32), np.arange(size, dtype=np.int32)], axis=1))
            blobs.append(rest.column("blob")[row].as_py())
        for held, name in zip(columns, ("minimisers", "ids", "text_keys", "starts"), strict=True):
            held.append(rest.column(name).flatten())
    if not blobs:
        return
    least = np.concatenate([c.to_numpy(zero_copy_only=False) for c in columns[0]])
    place = np.concatenate(places)
    order = np.argsort(least, kind="stable")
    same = np.diff(least[order]) == 0
    chosen = order[np.concatenate((same, [False])) | np.concatenate(([False], same))]
    if not len(chosen):
        return
    groups = np.split(np.arange(len(chosen)), np.flatnonzero(np.diff(least[chosen])) + 1)
    wanted = pa.array(chosen)
    ids = pa.chunked_array(columns[1], kind).take(wanted).to_pylist()
    text_keys = pa.chunked_array(columns[2]).take(wanted).to_pylist()
    starts = pa.chunked_array(columns[3]).take(wanted).to_pylist()
    columns.clear()
    lines: list[bytes] = [b""] * len(chosen)
    unpack = zstandard.ZstdDecompressor()
    by_blob = np.argsort(place[chosen, 0], kind="stable")
    for part in np.split(by_blob, np.flatnonzero(np.diff(place[chosen[by_blob], 0])) + 1):
        blob, at = place[chosen[part[0]], 0], place[chosen[part], 1].tolist()
        text = unpack.decompress(blobs[blob]).split(b"\n")
        for e, line in zip(part.tolist(), at, strict=True):
            lines[e] = text[line]
    blobs.clear()
    gone: list[tuple] = []
    for group in groups:
        seen: dict[bytes, tuple] = {}
        for e in sorted(group.tolist(), key=lambda e: (_key(ids[e]), text_keys[e], starts[e])):
            doc, text_key, start, line = ids[e], text_keys[e], starts[e], lines[e]
            cuts = [0, *[at + 1 for at in _blanks(line)], len(line) + 1]
            run = None
            for j in range(len(cuts) - WINDOW):
                mine = (doc, text_key, start + j)
                if seen.setdefault(line[cuts[j]:cuts[j + WINDOW] - 1], mine) == mine:
                    continue
                if run and run[1] == j - 1:
                    run = (run[0], j)
                    continue
                if run:
                    gone.append((doc, text_key, start + run[0], start + run[1] + WINDOW))
                run = (j, j)
            if run:
                gone.append((doc, text_key, start + run[0], start + run[1] + WINDOW))
        if len(gone) > 50_000:
            yield _stretches(gone, kind)
            gone = []
    yield _stretches(gone, kind)


def _blanks(line: bytes) -> list[int]:
    return np.flatnonzero(np.frombuffer(line, np.uint8) == 32).tolist()


def _stretches(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    return pa.record_batch([pa.array(columns[0], kind), *[pa.array(c, t) for c, t in zip(columns[1:], (pa.int32(), pa.int32(), pa.int32()), strict=True)]],
                           names=["id", "text_key", "first", "stop"])


def common_runs(rows: DataFrame, total: int) -> np.ndarray:
    """Hashes of runs that one in a hundred of the sampled documents holds; at most 100 times a document's words."""
    share = max(1, total // SAMPLE)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_batches(batches):
            for text in batch.column("text").to_pylist():
                words = text.split()
                found = np.unique(run_hashes(hashes(words), RUN) >> np.uint64(1))
                yield pa.record_batch([pa.array(found.astype(np.int64))], names=["run"])

    sample = rows.filter(F.pmod(F.xxhash64("id", "text_key"), F.lit(share)) == 0)
    often = sample.mapInArrow(runs, "run long").groupBy("run").agg(F.count("*").alias("n")).filter(F.col("n") >= SAMPLE * COMMON)
    return np.sort(often.select("run").toPandas()["run"].to_numpy(np.int64).astype(np.uint64))


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, text_key, text): the key tells texts apart under one id, in few bytes as it goes with every string."""
    text = text_of(text_column)
    return in_small_batches(docs).select(F.col(id_column).alias("id"), F.hash(text).alias("text_key"), F.encode(text, "UTF-8").alias("text"))


def repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, text_key, stretches): words covered by a window that starts earlier elsewhere, documents without any left out.

    Earlier: smaller id (null first), then smaller ``text_key``, or the same document and an earlier start.
    ``stretches`` are pairs (first, stop) of word numbers from 0 and may overlap.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = _rows(docs, id_column, text_column)
    sizes = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length(F.col(text_column))).alias("bytes")).first()
    buckets = max(shuffle_partitions(docs.sparkSession), -(-3 * (sizes["bytes"] or 0) // BUCKET_BYTES))
    packed = rows.mapInArrow(
        _pack(buckets, common_runs(rows, sizes["n"])),
        f"bucket int, blob binary, minimisers array<int>, ids array<{kind}>, text_keys array<int>, starts array<int>, windows array<int>")
    found = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_compare, f"id {kind}, text_key int, first int, stop int")
    return found.groupBy("id", "text_key").agg(F.collect_list(F.struct("first", "stop")).alias("stretches"))


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in row_batches(batches):
        ids, out = batch.column("id"), []
        for text, stretches in zip(batch.column("text").to_pylist(), batch.column("stretches").to_pylist(), strict=True):
            words = text.split()
            total = len(words)
            if stretches:
                keep = np.ones(total, bool)
                for s in stretches:
                    keep[s["first"]:s["stop"]] = False
                words = [words[i] for i in np.flatnonzero(keep)]
            out.append((total, total - len(words), b" ".join(words)))
        columns = list(zip(*out, strict=True))
        yield pa.record_batch([ids, pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                               pa.array(columns[2], pa.binary()).cast(pa.string()),
                               pa.array([hashlib.sha256(t).hexdigest() for t in columns[2]])],
                              names=["id", "n_words", "n_removed", "kept_text", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_text (kept words joined by one space), kept_sha256.

    Words are runs of non-blanks, taken unchanged.  A null or empty text, or one under 20 words, loses nothing.
    Rows that repeat id and text are one document and get the same answer; rows that repeat only the id are two
    documents, ordered by a hash of the text.  Windows are judged on the input.  Very long texts are packed
    window by window like others.  An empty table gives an empty one; other columns play no part.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    found = repeats(docs, id_column, text_column).withColumnsRenamed({"id": "r_id", "text_key": "r_key"})
    rows = _rows(docs, id_column, text_column)
    same = F.col("id").eqNullSafe(F.col("r_id")) & (F.col("text_key") == F.col("r_key"))
    return rows.join(found, same, "left").select("id", "text", "stretches").mapInArrow(
        _keep, f"id {kind}, n_words bigint, n_removed bigint, kept_text string, kept_sha256 string")
