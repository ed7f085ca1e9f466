"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Normaliser, pieces and byte fallback are compiled once per process: the normaliser to a rewriting of blanks,
pieces and fallback bytes to the arcs of a trie.  An input is composed with it (``lattice.Lattice``) and the
tropical-semiring shortest path taken: arcs cost minus the piece's score.

Two kinds of model are met.  In a unigram model any two pieces may follow each other.  In a merge (BPE) model a
further acceptor is composed: a pair of pieces is accepted only if building both by the model's merges
would never have joined what stands on either side of their border.  What is left is the path that the merges
make, so ids equal those of the reference encoder for either kind.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm import lattice
from graphloom.llm.common import in_small_batches, row_batches, text_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: stretches of text whose ids a worker keeps, in two generations: when one is full, the one before it goes
CACHE = 250_000
#: bytes of text in one lattice
LATTICE_BYTES = 250_000
BLANK = "▁"
_START, _NONE = -2, -1
_NEVER = np.int64(1) << 40


class Transducer:
    """A compiled model: stretches of normalised text -> ids, ids -> text."""

    def __init__(self, path: str) -> None:
        self.vocab = vocab = lattice.load(path)
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        settings = normaliser_settings(model.serialized_model_proto())
        if settings != {"type": 2, "charsmap": b"", "prefix": 1, "squeeze": 0, "escape": 1}:
            raise ValueError(f"only merge models with an identity normaliser are compiled here, not {settings}")
        order = sorted(vocab.ids.values(), key=lambda i: (-vocab.scores[i], i))
        ranks: dict[float, int] = {}
        self.birth = np.full(vocab.size, -1, np.int64)  # when merges make a piece; single characters are there from the start
        for i in order:
            rank = ranks.setdefault(float(vocab.scores[i]), len(ranks))
            if len(vocab.pieces[i].decode()) > 1:
                self.birth[i] = rank
        self.left, self.right = np.full(vocab.size, -1, np.int32), np.full(vocab.size, -1, np.int32)
        self.whole = np.zeros(vocab.size, bool)  # pieces that merges build from their own characters
        self.is_byte = np.zeros(vocab.size, bool)
        self.is_byte[vocab.byte_ids] = True
        pairs: dict[int, int] = {}
        for piece, number in vocab.ids.items():
            for at in range(1, len(piece)):
                a, b = vocab.ids.get(piece[:at]), vocab.ids.get(piece[at:])
                if a is not None and b is not None:
                    pairs[a * vocab.size + b] = number
        self._tabulate(pairs)
        for piece, number in vocab.ids.items():
            self._compile_merges(piece, number, pairs)
        surfaces = [p if p is not None else b"" for p in vocab.pieces]
        for byte, number in enumerate(vocab.byte_ids):
            surfaces[number] = bytes([byte])
        self.surface = np.frombuffer(b"".join(surfaces), np.uint8)
        self.width = np.array([len(s) for s in surfaces], np.int64)
        self.place = np.concatenate(([0], np.cumsum(self.width)[:-1]))
        # pieces hold no blank behind another character, and some characters stand in no piece: both cut the input
        if any(BLANK in p.decode().lstrip(BLANK) for p in vocab.ids):
            raise ValueError("pieces with inner blanks are not compiled here")
        inside = {c for p in vocab.ids for c in p.decode()}
        cuts = "".join(re.escape(c) for c in "\n\t\v\f" if c not in inside)
        self.stretches = re.compile(f"{BLANK}+[^{BLANK}{cuts}]*|[^{BLANK}{cuts}]+|[{cuts}]" if cuts else f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _compile_merges(self, piece: bytes, number: int, pairs: dict[int, int]) -> None:
        """Children of a piece: its last merge when it is built from its characters."""
        ids, size = self.vocab.ids, self.vocab.size
        parts = [ids.get(c.encode()) for c in piece.decode()]
        if None in parts:
            return
        while len(parts) > 1:
            ready = [(self.birth[pairs[a * size + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a * size + b in pairs]
            if not ready:
                return
            _, k = min(ready)
            made = pairs[parts[k] * size + parts[k + 1]]
            if len(parts) == 2:
                self.left[number], self.right[number] = parts
            parts[k:k + 2] = [made]
        self.whole[number] = True

    def _tabulate(self, pairs: dict[int, int]) -> None:
        """Open addressing over the pairs that merge: slot of a pair, or one of the few after it, holds its piece."""
        self.slots = 1 << (2 * len(pairs) - 1).bit_length()
        self.slot_keys, self.slot_ids = np.full(self.slots, -1, np.int64), np.full(self.slots, -1, np.int32)
        self.probes = 1
        for key, number in pairs.items():
            slot, tries = int(self._slot(np.array([key]))[0]), 1
            while self.slot_keys[slot] >= 0:
                slot, tries = (slot + 1) % self.slots, tries + 1
            self.slot_keys[slot], self.slot_ids[slot] = key, number
            self.probes = max(self.probes, tries)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(40)).astype(np.int64) & (self.slots - 1)

    def merged(self, key: np.ndarray) -> np.ndarray:
        """The piece that each pair merges to, -1 where it does not."""
        found = np.full(len(key), -1, np.int32)
        slot, ask = self._slot(key), np.arange(len(key))
        for _ in range(self.probes):
            held = self.slot_keys[slot]
            hit = held == key[ask]
            found[ask[hit]] = self.slot_ids[slot[hit]]
            on = ~hit & (held >= 0)
            if not on.any():
                break
            ask, slot = ask[on], (slot[on] + 1) & (self.slots - 1)
        return found

    def accepts(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether the merges that build each pair of pieces leave their border alone.

        Goes back in time from the finished pieces: whichever side was made last is taken apart, and at each
        step the two pieces at the border must not have joined while both were there.
        """
        x, y = before.astype(np.int64), after.astype(np.int64)
        good = self.whole[y] & self.whole[x]
        until_x, until_y = np.full(len(x), _NEVER), np.full(len(x), _NEVER)
        live = np.flatnonzero(good)
        while len(live):
            a, b = x[live], y[live]
            made = self.merged(a * self.vocab.size + b)
            joins = made >= 0
            rank = np.where(joins, self.birth[made], _NEVER)
            # of equal ranks the leftmost merge comes first: x's own before the border, the border before y's
            bad = joins & (rank < until_x[live]) & (rank <= until_y[live])
            good[live[bad]] = False
            live, a, b = live[~bad], a[~bad], b[~bad]
            born_x, born_y = self.birth[a], self.birth[b]
            older = (born_x >= 0) | (born_y >= 0)
            live, a, b, born_x, born_y = live[older], a[older], b[older], born_x[older], born_y[older]
            back_x = born_x > born_y
            until_x[live[back_x]], x[live[back_x]] = born_x[back_x], self.right[a[back_x]]
            until_y[live[~back_x]], y[live[~back_x]] = born_y[~back_x], self.left[b[~back_x]]
        return good

    def shortest_paths(self, texts: list[bytes]) -> list[bytes]:
        """Ids (int32, little endian) of each non-empty stretch of normalised text."""
        net = lattice.Lattice(self.vocab, texts)
        cost = np.full(net.positions, np.inf)
        last = np.full(net.positions, _NONE, np.int64)
        back = np.zeros(net.positions, np.int64)
        cost[net.first], last[net.first] = 0.0, _START
        for _, group in net.by_end():
            start, end, piece = net.start[group], net.end[group], net.piece[group].astype(np.int64)
            before = last[start]
            byte = self.is_byte[piece]
            free = (before == _START) | ((before >= 0) & (byte | self.is_byte[before]))
            ok = (before != _NONE) & (byte | self.whole[piece])
            ask = np.flatnonzero(ok & ~free)
            ok[ask] = self.accepts(before[ask], piece[ask])
            start, end, piece = start[ok], end[ok], piece[ok]
            price = cost[start] - self.vocab.scores[piece]
            order = np.argsort(-price, kind="stable")  # the cheapest is written last
            cost[end[order]], last[end[order]], back[end[order]] = price[order], piece[order], start[order]
        if (last[net.final] == _NONE).any():
            raise ValueError("a text has no path")
        # walk all paths back together
        at, owner = net.final.copy(), np.arange(len(texts))
        ids, owners = [], []
        while len(at):
            ids.append(last[at])
            owners.append(owner)
            at = back[at]
            more = last[at] != _START
            at, owner = at[more], owner[more]
        ids, owners = np.concatenate(ids[::-1]).astype("<i4"), np.concatenate(owners[::-1])
        order = np.argsort(owners, kind="stable")
        ids, ends = ids[order].tobytes(), np.cumsum(np.bincount(owners, minlength=len(texts))) * 4
        return [ids[low:high] for low, high in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.stretches.findall(normalise(t)) for t in texts]
        new = set().union(*split).difference(self.known)
        if len(self.known) + len(new) > CACHE:
            self.older, self.known = self.known, {}
            new = set().union(*split)
        again = self.older.keys() & new
        self.known.update((s, self.older[s]) for s in again)
        new -= again
        low, pending = 0, sorted(new, key=len)
        while low < len(pending):
            high, size = low, 0
            while high < len(pending) and (high == low or size + len(pending[high]) < LATTICE_BYTES):
                size += len(pending[high])
                high += 1
            part = pending[low:high]
            self.known.update(zip(part, self.shortest_paths([s.encode("utf-8", "replace") for s in part]), strict=True))
            low = high
        known = self.known
        return [np.frombuffer(b"".join([known[s] for s in stretches]), "<i4") for stretches in split]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; the blank that encoding puts before a text is taken off."""
        width = self.width[ids]
        shift = self.place[ids] - np.concatenate(([0], np.cumsum(width)[:-1])) if len(ids) else width
        flat = self.surface[np.repeat(shift, width) + np.arange(int(width.sum()))].tobytes()
        return flat.decode("utf-8", "replace").replace(BLANK, " ").removeprefix(" ")


def normalise(text: str) -> str:
    """The identity normaliser with a blank before the text; blanks become the model's own sign."""
    return BLANK + text.replace(" ", BLANK) if text else ""


def normaliser_settings(model: bytes) -> dict:
    """What a serialized model says of its kind and normaliser (fields of the public message format)."""
    def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
        at = 0

        def number() -> int:
            nonlocal at
            value = shift = 0
            while True:
                byte = data[at]
                at += 1
                value |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    return value

        while at < len(data):
            tag = number()
            if tag & 7 == 0:
                yield tag >> 3, number()
            else:
                size = {1: 8, 5: 4}.get(tag & 7) or number()
                yield tag >> 3, data[at:at + size]
                at += size

    found = {"type": 1, "charsmap": b"", "prefix": 1, "squeeze": 1, "escape": 1}
    for field, value in fields(model):
        if field == 2:
            found |= {"type": v for k, v in fields(value) if k == 3}
        elif field == 3:
            names = {2: "charsmap", 3: "prefix", 4: "squeeze", 5: "escape"}
            found |= {names[k]: v for k, v in fields(value) if k in names}
    return found


@lru_cache(2)
def compiled(path: str) -> Transducer:
    """The transducer of a model file, once per process."""
    return Transducer(path)


def _ids_column(rows: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    values = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))


def encode(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: str = MODEL) -> DataFrame:
    """(id, ids array<int>) of every row's whole text; a null or empty text has no ids.

    Characters outside the vocabulary become the pieces of their bytes.  Very long texts are encoded whole,
    one batch in memory at a time.  Repeated rows and null ids come through; only the named columns are read.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_batches(batches):
            ids = compiled(model).encode(batch.column("text").to_pylist())
            yield pa.record_batch([batch.column("id"), _ids_column(ids)], names=["id", "ids"])

    return in_small_batches(docs).select(F.col(id_column).alias("id"), text_of(text_column).alias("text")).mapInArrow(run, f"id {kind}, ids array<int>")


def decode(coded: DataFrame, id_column: str = "id", ids_column: str = "ids", model: str = MODEL) -> DataFrame:
    """(id, text) of every row's ids; null or no ids give an empty text."""
    kind = coded.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_batches(batches):
            texts = [compiled(model).decode(np.array(i or [], np.int64)) for i in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("id"), pa.array(texts, pa.string())], names=["id", "text"])

    return in_small_batches(coded).select(F.col(id_column).alias("id"), F.col(ids_column).alias("ids")).mapInArrow(run, f"id {kind}, text string")


def round_trip(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: str = MODEL) -> DataFrame:
    """(id, ids, n_ids, decoded_sha256, exact): ids of every text, and the text decoded from them again.

    ``exact``: the decoded text equals the input.  The one exception is a text that holds the model's sign
    for a blank (U+2581) itself, which comes back as a blank.  Edge cases are those of ``encode``.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(model)
        for batch in row_batches(batches):
            texts = batch.column("text").to_pylist()
            ids = machine.encode(texts)
            again = [machine.decode(i) for i in ids]
            yield pa.record_batch([
                batch.column("id"), _ids_column(ids), pa.array([len(i) for i in ids], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in again]),
                pa.array([a == b for a, b in zip(again, texts, strict=True)]),
            ], names=["id", "ids", "n_ids", "decoded_sha256", "exact"])

    return in_small_batches(docs).select(F.col(id_column).alias("id"), text_of(text_column).alias("text")).mapInArrow(
        run, f"id {kind}, ids array<int>, n_ids bigint, decoded_sha256 string, exact boolean")
