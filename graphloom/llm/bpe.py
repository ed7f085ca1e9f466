"""Byte-level BPE encoding and decoding by forced-boundary splitting.

A merge joins two neighbouring byte strings into a vocabulary token, so two bytes that stand side by side in no
token are never joined: between them a cut is certain.  Words (the tokenizer's own pre-tokenisation) are cut at all
such byte pairs, the fragments are encoded independently, and the ids concatenated.

The fragments of a batch are encoded together: in each round every fragment joins its pair of lowest rank, at all
places where it stands.  A fragment too long for that (its rounds grow with its length) uses a heap of its pairs.
Tokenizer files are read as data; the merges are made here.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import in_small_batches, row_batches, text_of

MODEL = "/opt/tokenizers/byte_bpe_50k.json"
#: words whose ids a worker keeps, in two generations: when one is full, the one before it goes
CACHE = 200_000
#: longer words (characters) are encoded but not kept
CACHED_LENGTH = 48
#: bytes of words that are encoded together, and characters of text that are cut into words together
TOGETHER = 1 << 20
#: fragments of more bytes are encoded one at a time
LONG = 256
_NEVER = np.int32(2**31 - 1)

# fixed values: letters and numbers that Unicode 16.0 added to 15.1, as (first, last)
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]
# fixed values: characters with the White_Space property, as (first, last)
WHITE_SPACE = [(9, 13), (32, 32), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4


@lru_cache(1)
def classes() -> np.ndarray:
    """Letter, number, white space or other, for every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    for kind, ranges in ((LETTER, NEW_LETTERS), (NUMBER, NEW_NUMBERS), (SPACE, WHITE_SPACE)):
        for low, high in ranges:
            table[low:high + 1] = kind
    return table


def word_starts(points: np.ndarray, sections: np.ndarray) -> np.ndarray:
    """Where words start in code points, of which some start a section: nothing reaches over a section's start.

    A word is a contraction ('s 't 're 've 'm 'll 'd), or a run of letters, of numbers or of other signs with at
    most one blank before it, or white space that is left.
    """
    n = len(points)
    kind = classes()[points]
    first = np.ones(n, bool)
    first[1:] = kind[1:] != kind[:-1]
    first |= sections
    follows = np.zeros(n, bool)  # not white space, behind white space
    follows[1:] = (kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~sections[1:]
    at = np.flatnonzero(follows)
    first[at - 1] = True
    first[at[points[at - 1] == 32]] = False
    quote = np.flatnonzero((points == 39) & first)
    if len(quote):
        padded, blocked = np.append(points, [0, 0]), np.append(sections, [True, True])
        one = np.where(blocked[quote + 1], 0, padded[quote + 1])
        two = np.where(blocked[quote + 1] | blocked[quote + 2], 0, padded[quote + 2])
        short = np.isin(one, [ord(c) for c in "stmd"])
        wide = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        first[quote[short | wide] + 1] = False
        ends = np.concatenate((quote[short] + 2, quote[wide] + 3))
        first[ends[ends < n]] = True
    return np.flatnonzero(first)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """A byte-level BPE file: texts -> ids, ids -> texts."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, before = data["model"], data["pre_tokenizer"] or {}
        plain = {k: model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)}
        if model["type"] != "BPE" or plain or data["normalizer"] or before.get("type") != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"]:
            raise ValueError("only byte-level BPE without normaliser, prefix blank or dropout is encoded here")
        alphabet = byte_alphabet()
        surface = {i: bytes(alphabet[c] for c in token) for token, i in model["vocab"].items()}
        self.inside = np.zeros((256, 256), bool)
        for token in surface.values():
            codes = np.frombuffer(token, np.uint8)
            self.inside[codes[:-1], codes[1:]] = True
        by_surface = {s: i for i, s in surface.items()}
        self.byte_ids = np.array([by_surface[bytes([b])] for b in range(256)], np.int32)
        self.specials = {t["content"]: t["id"] for t in data["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in data["added_tokens"]):
            raise ValueError("added tokens must be matched as they are")
        surface |= {i: s.encode() for s, i in self.specials.items()}
        self.special = re.compile("|".join(re.escape(s) for s in sorted(self.specials, key=len, reverse=True))) if self.specials else None

        self.size = size = max(surface) + 1
        self.ranks: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks.setdefault(model["vocab"][a] * size + model["vocab"][b], (rank, model["vocab"][a + b]))
        self.keys = np.array(sorted(self.ranks), np.int64)
        self.rank_of = np.array([self.ranks[k][0] for k in self.keys.tolist()], np.int32)
        self.made = np.zeros(len(model["merges"]), np.int32)
        for rank, made in self.ranks.values():
            self.made[rank] = made
        pairs = self.byte_ids[:, None].astype(np.int64) * size + self.byte_ids[None, :]
        self.byte_ranks = self._ranks(pairs.ravel()).reshape(256, 256)

        parts = [surface.get(i, b"") for i in range(size)]
        self.flat = np.frombuffer(b"".join(parts), np.uint8)
        self.width = np.array([len(p) for p in parts], np.int64)
        self.place = np.concatenate(([0], np.cumsum(self.width)[:-1]))
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ranks(self, pairs: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(self.keys[at] == pairs, self.rank_of[at], _NEVER)

    def merge_together(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all fragments, and the place of each id's first byte."""
        lengths = np.diff(np.append(starts, len(codes)))
        symbol, place = self.byte_ids[codes], np.arange(len(codes))
        rank = np.full(len(codes), _NEVER, np.int32)
        rank[:-1] = self.byte_ranks[codes[:-1], codes[1:]]
        rank[starts[1:] - 1] = _NEVER
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            least = np.minimum.reduceat(rank, starts)
            live = least != _NEVER
            if not live.all():
                inside = np.repeat(live, lengths)
                done.append((symbol[~inside], place[~inside]))
                symbol, place, rank = symbol[inside], place[inside], rank[inside]
                lengths, least = lengths[live], least[live]
                if not len(symbol):
                    break
            chosen = rank == np.repeat(least, lengths)
            again = np.flatnonzero(chosen[1:] & chosen[:-1]) + 1
            if len(again):  # a run of one sign: every other place, from the left
                at = np.arange(len(chosen))
                head = chosen.copy()
                head[1:] &= ~chosen[:-1]
                offset = at - np.maximum.accumulate(np.where(head, at, 0))
                chosen &= offset % 2 == 0
            hit = np.flatnonzero(chosen)
            symbol[hit] = self.made[rank[hit]]
            rank[hit] = rank[hit + 1]
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            owner = np.repeat(np.arange(len(lengths)), lengths)
            lengths = lengths - np.bincount(owner[hit], minlength=len(lengths))
            symbol, place, rank = symbol[keep], place[keep], rank[keep]
            hit = hit - np.arange(len(hit))
            ends = np.cumsum(lengths)
            starts = ends - lengths
            edge = np.zeros(len(symbol), bool)
            edge[ends - 1] = True
            ask = np.concatenate((hit, hit[hit > 0] - 1))
            ask = ask[~edge[ask]]
            rank[ask] = self._ranks(symbol[ask].astype(np.int64) * self.size + symbol[ask + 1])
            rank[hit[edge[hit]]] = _NEVER
        symbols = np.concatenate([d[0] for d in done]) if done else symbol
        places = np.concatenate([d[1] for d in done]) if done else place
        order = np.argsort(places, kind="stable")
        return symbols[order], places[order]

    def merge_long(self, codes: np.ndarray) -> tuple[list[int], list[int]]:
        """The same for one fragment of any length, in n log n steps."""
        symbol = self.byte_ids[codes].tolist()
        n, size, ranks = len(symbol), self.size, self.ranks
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, symbol[i], symbol[i + 1]) for i, r in enumerate(self.byte_ranks[codes[:-1], codes[1:]].tolist()) if r != _NEVER]
        heapq.heapify(heap)

        def offer(i: int, j: int) -> None:
            found = ranks.get(symbol[i] * size + symbol[j])
            if found:
                heapq.heappush(heap, (found[0], i, symbol[i], symbol[j]))

        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or symbol[i] != a or j >= n or symbol[j] != b:
                continue
            symbol[i] = ranks[a * size + b][1]
            alive[j] = False
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        places = [i for i in range(n) if alive[i]]
        return [symbol[i] for i in places], places

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids (32 bits, little endian) of each non-empty word."""
        raw = [w.encode("utf-8", "replace") for w in words]
        codes = np.frombuffer(b"".join(raw), np.uint8)
        lengths = np.array([len(r) for r in raw])
        word_at = np.cumsum(lengths) - lengths
        first = np.ones(len(codes), bool)
        first[1:] = ~self.inside[codes[:-1], codes[1:]]
        first[word_at] = True
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(codes)))
        out = np.full(len(codes), -1, np.int32)
        wide = np.flatnonzero(sizes > LONG)
        for k in wide:
            symbols, places = self.merge_long(codes[starts[k]:starts[k] + sizes[k]])
            out[starts[k] + np.array(places)] = symbols
        if len(wide):
            short = np.repeat(sizes <= LONG, sizes)
            where, part = np.flatnonzero(short), sizes[sizes <= LONG]
            if len(where):
                symbols, places = self.merge_together(codes[where], np.cumsum(part) - part)
                out[where[places]] = symbols
        else:
            symbols, places = self.merge_together(codes, starts)
            out[places] = symbols
        filled = out >= 0
        ends = np.cumsum(np.add.reduceat(filled, word_at)) * 4
        ids = out[filled].astype("<i4").tobytes()
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def learn(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of all the words, from those kept and those encoded now."""
        new = set(words).difference(self.known)
        if len(self.known) + len(new) > CACHE:
            self.older, self.known = self.known, {}
            new = set(words)
        again = self.older.keys() & new
        self.known.update((w, self.older[w]) for w in again)
        new -= again
        pending, size, brief = [], 0, {}

        def flush() -> None:
            for word, ids in zip(pending, self.encode_words(pending), strict=True):
                (self.known if len(word) <= CACHED_LENGTH else brief)[word] = ids
            pending.clear()

        for word in new:
            pending.append(word)
            size += len(word)
            if size >= TOGETHER:
                flush()
                size = 0
        if pending:
            flush()
        return brief

    def sections(self, text: str) -> Iterator[str | int]:
        """Stretches of text that no word crosses, and the ids of special tokens between them."""
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            if found.start() > at:
                yield from _pieces(text[at:found.start()])
            yield self.specials[found.group()]
            at = found.end()
        if at < len(text):
            yield from _pieces(text[at:])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids (32 bits, little endian) of every text."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[str] = []
        slots: list[tuple[int, int]] = []
        size = 0

        def flush() -> None:
            joined = "".join(held)
            points = np.frombuffer(joined.encode("utf-32-le", "replace"), "<u4")
            lengths = np.array([len(h) for h in held])
            heads = np.cumsum(lengths) - lengths
            sections = np.zeros(len(points), bool)
            sections[heads] = True
            starts = word_starts(points, sections)
            bounds = starts.tolist()
            words = [joined[a:b] for a, b in zip(bounds, [*bounds[1:], len(joined)], strict=True)]
            brief = self.learn(words)
            known = self.known
            ids = [known[w] if w in known else brief[w] for w in words]
            edges = np.searchsorted(starts, np.append(heads, len(points))).tolist()
            for (text, slot), a, b in zip(slots, edges[:-1], edges[1:], strict=True):
                out[text][slot] = b"".join(ids[a:b])
            held.clear()
            slots.clear()

        for k, text in enumerate(texts):
            for part in self.sections(text):
                if isinstance(part, int):
                    out[k].append(part.to_bytes(4, "little"))
                    continue
                slots.append((k, len(out[k])))
                out[k].append(b"")
                held.append(part)
                size += len(part)
                if size >= TOGETHER:
                    flush()
                    size = 0
        if held:
            flush()
        return [b"".join(parts) for parts in out]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids, special tokens as they are written; bytes that are no UTF-8 become U+FFFD, unknown ids nothing."""
        ids = ids[(ids >= 0) & (ids < self.size)]
        if not len(ids):
            return ""
        width = self.width[ids]
        shift = self.place[ids] - (np.cumsum(width) - width)
        return self.flat[np.repeat(shift, width) + np.arange(int(width.sum()))].tobytes().decode("utf-8", "replace")


def _pieces(text: str) -> Iterator[str]:
    """A long text in parts, cut before a single blank between two signs: a word starts there for certain."""
    at = 0
    while len(text) - at > TOGETHER:
        found = _SINGLE_BLANK.search(text, at + TOGETHER)
        if not found:
            break
        yield text[at:found.start()]
        at = found.start()
    yield text[at:] if at else text


_SINGLE_BLANK = re.compile(r"(?<=[^\s]) (?=[^\s])")


@lru_cache(2)
def loaded(path: str) -> Encoder:
    """The encoder of a tokenizer file, once per process."""
    return Encoder(path)


def _ids_column(rows: list[bytes]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(r) // 4 for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), "<i4")))


def encode(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: str = MODEL) -> DataFrame:
    """(id, ids array<int>) of every row's whole text; a null or empty text has no ids.

    Strings of special tokens in a text become those tokens.  Very long texts are encoded whole, part by part; a
    stretch without any certain cut costs n log n steps.  Repeated rows and null ids come through, an empty table
    gives an empty one, and only the two named columns are read.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_batches(batches, size=4 << 20):
            ids = loaded(model).encode(batch.column("text").to_pylist())
            yield pa.record_batch([batch.column("id"), _ids_column(ids)], names=["id", "ids"])

    return in_small_batches(docs).select(F.col(id_column).alias("id"), text_of(text_column).alias("text")).mapInArrow(run, f"id {kind}, ids array<int>")


def decode(coded: DataFrame, id_column: str = "id", ids_column: str = "ids", model: str = MODEL) -> DataFrame:
    """(id, text) of every row's ids; null or no ids give an empty text, null or unknown ids in a list nothing."""
    kind = coded.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_batches(batches, size=4 << 20):
            rows = [[i for i in r or [] if i is not None] for r in batch.column("ids").to_pylist()]
            texts = [loaded(model).decode(np.array(r, np.int64)) for r in rows]
            yield pa.record_batch([batch.column("id"), pa.array(texts, pa.string())], names=["id", "text"])

    return in_small_batches(coded).select(F.col(id_column).alias("id"), F.col(ids_column).alias("ids")).mapInArrow(run, f"id {kind}, text string")


def round_trip(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: str = MODEL) -> DataFrame:
    """(id, ids, n_tokens, ids_sha256, decoded_sha256, exact): every text encoded, and decoded from its ids again.

    ``ids_sha256`` is that of the ids as little-endian unsigned 32-bit integers, ``exact`` says that the decoded text
    is the input.  Edge cases are those of ``encode``.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = loaded(model)
        for batch in row_batches(batches, size=4 << 20):
            texts = batch.column("text").to_pylist()
            ids = machine.encode(texts)
            again = [machine.decode(np.frombuffer(i, "<i4")) for i in ids]
            yield pa.record_batch([
                batch.column("id"), _ids_column(ids), pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in again]),
                pa.array([a == b for a, b in zip(again, texts, strict=True)]),
            ], names=["id", "ids", "n_tokens", "ids_sha256", "decoded_sha256", "exact"])

    return in_small_batches(docs).select(F.col(id_column).alias("id"), text_of(text_column).alias("text")).mapInArrow(
        run, f"id {kind}, ids array<int>, n_tokens bigint, ids_sha256 string, decoded_sha256 string, exact boolean")
