"""Segmentation lattices of many short texts at once.

A vocabulary is compiled to a byte trie held as one table.  Composing it with a batch of texts gives every arc
(start, end, piece) in one sweep over the bytes; shortest paths and sums over all segmentations then walk the
end positions of all texts together.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import sentencepiece


class Vocabulary:
    """Pieces as bytes, their scores, the byte-fallback pieces, and the trie over the pieces."""

    def __init__(self, pieces: list[bytes | None], scores: list[float], byte_ids: np.ndarray) -> None:
        """``pieces``: None where an id spells no text (control, unknown and byte pieces)."""
        self.pieces, self.scores, self.byte_ids = pieces, np.array(scores), byte_ids
        self.size = len(pieces)
        self.longest = max(len(p) for p in pieces if p is not None)
        self.ids = {p: i for i, p in enumerate(pieces) if p is not None}
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for piece, number in self.ids.items():
            node = 0
            for byte in piece:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    ends.append(-1)
                node = children[node][byte]
            ends[node] = number
        self.ends = np.array(ends, np.int32)
        self.step = np.zeros((len(children), 256), np.int32)  # 0, the root, is no node's child
        for node, sons in enumerate(children):
            for byte, son in sons.items():
                self.step[node, byte] = son


@lru_cache(2)
def load(path: str) -> Vocabulary:
    """The vocabulary of a model file, once per process."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    silent = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(size)]
    pieces = [None if silent[i] else model.id_to_piece(i).encode() for i in range(size)]
    byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
    return Vocabulary(pieces, [model.get_score(i) for i in range(size)], byte_ids)


class Lattice:
    """All arcs of a batch of texts.  Each text of n bytes has n + 1 positions, numbered through the batch."""

    def __init__(self, vocabulary: Vocabulary, texts: list[bytes]) -> None:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        flat = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        self.sizes, self.first = sizes, offsets[:-1] + np.arange(len(texts))
        self.final = self.first + sizes
        self.positions = len(flat) + len(texts)
        text_of = np.repeat(np.arange(len(texts)), sizes)
        stop = np.repeat(offsets[1:], sizes)

        starts, lengths, pieces = [], [], []
        begin = np.arange(len(flat))
        node = vocabulary.step[0][flat]
        for length in range(1, vocabulary.longest + 1):
            alive = node > 0
            begin, node = begin[alive], node[alive]
            piece = vocabulary.ends[node]
            found = piece >= 0
            starts.append(begin[found])
            lengths.append(np.full(int(found.sum()), length))
            pieces.append(piece[found])
            inside = begin + length < stop[begin]
            begin, node = begin[inside], node[inside]
            if not len(begin):
                break
            node = vocabulary.step[node, flat[begin + length]]

        # byte fallback: characters that are no piece themselves
        heads = np.flatnonzero((flat & 0xC0) != 0x80)
        width = np.diff(np.concatenate((heads, [len(flat)])))
        own = np.zeros(len(flat) + 1, bool)
        char_width = np.zeros(len(flat) + 1, np.int64)
        char_width[heads] = width
        for s, n in zip(starts, lengths, strict=True):
            own[s[char_width[s] == n]] = True
        head_of = np.repeat(heads, width)
        loose = np.flatnonzero(~own[head_of]) if len(heads) else heads
        starts.append(loose)
        lengths.append(np.ones(len(loose), np.int64))
        pieces.append(vocabulary.byte_ids[flat[loose]])

        start, length = np.concatenate(starts), np.concatenate(lengths)
        text = text_of[start] if len(start) else start
        start = start + text
        end = start + length
        place = end - self.first[text] if len(start) else start
        key = place * (vocabulary.longest + 1) + length
        # short keys sort by radix
        order = np.argsort(key.astype(np.uint16) if len(key) and key.max() < 1 << 16 else key, kind="stable")
        self.start, self.end, self.piece = start[order], end[order], np.concatenate(pieces)[order]
        self.length, self.place, self.text = length[order], place[order], text[order]

    def by_end(self) -> Iterator[tuple[int, slice]]:
        """Arcs by the place in their text where they end, first places first."""
        cuts = np.flatnonzero(np.diff(self.place)) + 1
        for low, high in zip([0, *cuts], [*cuts, len(self.place)], strict=True):
            if high > low:
                yield int(self.place[low]), slice(low, high)

    def by_end_and_length(self) -> list[slice]:
        """The same in groups in which no two arcs end at the same position."""
        cuts = np.flatnonzero(np.diff(self.place) | np.diff(self.length)) + 1
        return [slice(low, high) for low, high in zip([0, *cuts], [*cuts, len(self.place)], strict=True) if high > low]


#: probabilities are carried times this to the number of bytes, to stay near 1
PER_BYTE = 24.0


def forward(lattice: Lattice, weights: np.ndarray, every: int = 16) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum over all segmentations: (log total per text and column, scaled sums per position, log scale per text).

    ``weights``: probability of each piece, one column per model.  Sums are rescaled on the way through a long text,
    each ``every`` bytes: unseen bytes of 1e-9 cannot underflow in between.
    """
    columns = weights.shape[1]
    reach = np.zeros((lattice.positions, columns))
    reach[lattice.first] = 1.0
    scale = np.zeros((len(lattice.sizes), columns))
    since, window, furthest = 0, int(lattice.length.max(initial=1)), None
    for group in lattice.by_end_and_length():
        place = int(lattice.place[group.start])
        if place - since >= every:
            # divide by the largest sum that an arc to come starts from; what lies behind may be far larger
            since = place
            if furthest is None:
                furthest = np.zeros(lattice.positions, np.int64)
                np.maximum.at(furthest, lattice.start, lattice.place)
            texts = np.flatnonzero(lattice.sizes >= place)
            near = lattice.first[texts][:, None] + np.arange(max(0, place - window), place)
            reach[near] *= (furthest[near] >= place)[:, :, None]
            most = reach[near].max(axis=1)
            most[most <= 0] = 1.0
            reach[near] /= most[:, None, :]
            scale[texts] += np.log(most)
        gain = PER_BYTE ** float(lattice.length[group.start])
        reach[lattice.end[group]] += reach[lattice.start[group]] * (weights[lattice.piece[group]] * gain)
    with np.errstate(divide="ignore"):
        total = np.log(reach[lattice.final]) + scale - lattice.sizes[:, None] * np.log(PER_BYTE)
    return total, reach, scale
