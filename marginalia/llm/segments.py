"""Encoding of texts by segments between spaces: each distinct segment of a block is looked up once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Segments of the newer generation that a worker remembers; then it becomes the older one. Only time depends on it.
REMEMBERED = 350_000
LONGEST_REMEMBERED = 64
#: Characters of the texts that are encoded together, about.
TOGETHER = 4_000_000


class _Known(dict):
    """Encodings by segment. A segment that only the older generation has moves over; one that neither has counts as
    missing and stands for nothing yet."""

    def __init__(self, older: dict[str, bytes]):
        super().__init__()
        self.older = older
        self.missing: list[str] = []

    def __missing__(self, segment: str) -> bytes:
        ids = self.older.get(segment)
        if ids is None:
            self.missing.append(segment)
            return b""
        self[segment] = ids
        return ids


class SegmentEncoder:
    """Encodes whole texts as the concatenation of their segments' encodings.

    ``prepare`` turns a text into one whose spaces are where the tokenizer cannot join or look across, or into null for a text that
    ``whole`` encodes by itself; ``pieces`` cuts a segment further, into segments whose encodings make up its own, unless ``plain`` says that it is
    one; ``encode_all`` encodes a list of distinct pieces. Encodings are little-endian unsigned 32-bit integers. What a worker has encoded it
    remembers for two generations: frequent segments pass from the older to the newer one.
    """

    def __init__(self, plain: Callable[[str], object], pieces: Callable[[str], list[str]], encode_all: Callable[[list[str]], list[bytes]], prepare: Callable[[pa.Array], pa.Array] | None = None, whole: Callable[[str], bytes] | None = None):
        self.plain, self.pieces, self.encode_all, self.prepare, self.whole = plain, pieces, encode_all, prepare, whole
        self.known = _Known({})

    def _look_up(self, segments: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known = _Known(dict(self.known))
        known, missing = self.known, self.known.missing
        get = known.__getitem__
        out = list(map(get, segments))
        if not missing:
            return out
        fresh = missing.copy()
        missing.clear()
        plain = self.plain
        cut = [(s, self.pieces(s)) for s in fresh if not plain(s)]
        for _, pieces in cut:
            for p in pieces:
                get(p)
        new = list(dict.fromkeys([*filter(plain, fresh), *missing]))
        missing.clear()
        known.update(zip(new, self.encode_all(new), strict=True))
        for s, pieces in cut:
            if len(pieces) != 1 or pieces[0] != s:
                known[s] = b"".join(map(get, pieces))
        out = list(map(get, segments))
        for s in (*fresh, *new):
            if len(s) > LONGEST_REMEMBERED:
                known.pop(s, None)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's begin and the last one's end. Null counts as empty."""
        texts = pc.fill_null(texts, "")
        ready = self.prepare(texts) if self.prepare else texts
        alone = ready.is_null().to_numpy(zero_copy_only=False).nonzero()[0].tolist() if ready.null_count else []
        lists = pc.split_pattern(pc.fill_null(ready, "") if alone else ready, " ")
        named = lists.flatten().dictionary_encode()
        found = self._look_up(named.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), "i8", len(found)) // 4
        values = np.frombuffer(b"".join(found), "<u4")
        index = named.indices.to_numpy()
        counts, first = sizes[index], (np.cumsum(sizes) - sizes)[index]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        ids = values[np.repeat(first - (ends - counts), counts) + np.arange(total)]
        at = lists.offsets.to_numpy()
        offsets = np.concatenate([[0], ends])[at - at[0]]
        if not alone:
            return ids, offsets
        rows = np.split(ids, offsets[1:-1])
        for k in alone:
            rows[k] = np.frombuffer(self.whole(texts[k].as_py()), "<u4")  # type: ignore[misc]
        return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])

    def encode_list(self, texts: list[str]) -> list[bytes]:
        ids, at = self.encode(pa.array(texts, pa.string()))
        raw, at = ids.tobytes(), (4 * at).tolist()
        return [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def slices(texts: pa.Array, together: int = TOGETHER) -> Iterator[tuple[int, int]]:
    """First row and number of rows of stretches of about ``together`` bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    first, size = 0, 0
    for k, n in enumerate(sizes.tolist()):
        size += n
        if size >= together:
            yield first, k + 1 - first
            first, size = k + 1, 0
    if first < len(sizes):
        yield first, len(sizes) - first


def blocks(texts: pa.Array, together: int = 1_000_000) -> Iterator[list[str]]:
    """The texts in order, null as empty, in lists of about ``together`` bytes."""
    for first, n in slices(texts, together):
        yield [t or "" for t in texts.slice(first, n).to_pylist()]


def encoded(batch: pa.RecordBatch, text: str, encoder: SegmentEncoder) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch, each with its rows' ids and where they begin and end."""
    for first, n in slices(batch.column(text)):
        part = batch.slice(first, n)
        yield part, *encoder.encode(part.column(text))
