"""Byte-level BPE by replaying the merges over all distinct words of a block of texts."""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .segments import SegmentEncoder, encoded
#: From so many positions on, the merges of a rank are made by array operations.
AT_ONCE = 32


class Ranks:
    """A vocabulary of byte strings with their ranks, which are their ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.first = [ranks[bytes([b])] for b in range(256)]
        first = np.full((256, 256), -1, "i4")
        for b, i in ranks.items():
            if len(b) == 2:
                first[b[0], b[1]] = i
        self.byte_pairs = first
        pairs = [(ranks[x[:k]] << 32 | ranks[x[k:]], r) for x, r in ranks.items() for k in range(1, len(x)) if x[:k] in ranks and x[k:] in ranks]
        table = np.array(sorted(pairs), "i8").reshape(-1, 2)
        self.pair_keys, self.pair_ranks = np.ascontiguousarray(table[:, 0]), np.ascontiguousarray(table[:, 1])
        self.pairs = dict(pairs)  # of the two ids in one number, to the id that they merge to

    @classmethod
    def load(cls, path: str) -> Ranks:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})

    def pair_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ids that pairs merge to, or -1; negative tokens have no pair."""
        key = a.astype("i8") << 32 | np.maximum(b, 0)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (a >= 0) & (b >= 0), self.pair_ranks[at], -1)

    def replay(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers: of all neighbouring pairs the one with the lowest rank merges first, the leftmost of equals.

        The words lie one after another in one array of tokens. An inverted index holds the positions of each pair that
        can merge, under the rank of the merge; ranks are taken from a heap. A merge touches its two neighbours only: their
        new pairs enter the index. Positions whose pair has changed meanwhile are passed over. If a merge makes a pair of
        lower rank, the later positions of that word wait until that pair has had its turn. Where no position overlaps another and
        none makes a pair of lower rank, all of a rank merge at once.
        """
        out = [b""] * len(words)
        todo = []
        for k, w in enumerate(words):
            whole = self.ranks.get(w)
            if whole is not None:
                out[k] = whole.to_bytes(4, "little")
            elif w:
                todo.append(k)
        if not todo:
            return out
        raw = np.frombuffer(b"\0".join([words[k] for k in todo]) + b"\0", "u1")
        ends = np.cumsum([len(words[k]) + 1 for k in todo]) - 1
        inner = np.ones(len(raw), bool)
        inner[ends] = False
        token = np.asarray(self.first)[raw]
        token[~inner] = -1
        starts = [0, *(ends[:-1] + 1).tolist()]
        rank = np.where(inner[:-1] & inner[1:], self.byte_pairs[raw[:-1], raw[1:]], -1)
        at = np.flatnonzero(rank >= 0)
        order = np.argsort(rank[at], kind="stable")
        at, by = at[order], rank[at][order]
        cuts = np.flatnonzero(np.diff(by)) + 1
        index = {int(r): p.tolist() for r, p in zip(by[np.r_[0, cuts]], np.split(at, cuts), strict=True)} if len(at) else {}
        heap = list(index)
        heapq.heapify(heap)
        n = len(token)
        tok, after, before = (array("i", x.astype("i4").tobytes()) for x in (token, np.arange(1, n + 1), np.arange(-1, n - 1)))
        toks, afters, befores = (np.frombuffer(x, "i4") for x in (tok, after, before))

        merged = self.pairs.get

        def enter(ranks: np.ndarray, at: np.ndarray) -> None:
            real = ranks >= 0
            ranks, at = ranks[real], at[real]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            ranks, at = ranks[order], at[order].tolist()
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            x = 0
            for r, e in zip(ranks[np.r_[0, cuts]].tolist(), [*cuts.tolist(), len(at)], strict=True):
                if r in index:
                    index[r] += at[x:e]
                else:
                    index[r] = at[x:e]
                    heapq.heappush(heap, r)
                x = e

        def at_once(r: int, positions: list[int]) -> bool:
            p = np.sort(np.array(positions, "i4"))
            a, q = toks[p], afters[p]
            ok = (a >= 0) & (q < n)
            p, a, q = p[ok], a[ok], q[ok]
            ok = self.pair_of(a, toks[q]) == r
            ok[1:] &= p[1:] != p[:-1]
            p, q = p[ok], q[ok]
            nxt, left = afters[q], befores[p]
            near = left >= 0
            left, at = left[near], p[near]
            right, lefts = self.pair_of(np.full(len(p), r), toks[nxt]), self.pair_of(toks[left], np.full(len(left), r))
            lower = lambda x: ((x >= 0) & (x < r)).any()
            if (q[:-1] == p[1:]).any() or lower(right) or lower(lefts):
                return False
            touch = nxt[:-1] == p[1:]  # neighbours that both merge
            if touch.any():
                if 0 <= merged(r << 32 | r, -1) < r:
                    return False
                toks[p], toks[q] = r, -2
                right, lefts = self.pair_of(toks[p], toks[nxt]), self.pair_of(np.where(np.isin(left, q), r, toks[left]), toks[at])
            else:
                toks[p], toks[q] = r, -2
            afters[p], befores[nxt] = nxt, p
            left = befores[at]
            enter(right, p)
            enter(lefts, left)
            return True

        while heap:
            r = heapq.heappop(heap)
            positions = index.pop(r)
            if len(positions) >= AT_ONCE and at_once(r, positions):
                continue
            positions.sort()
            wait = -1  # positions below it wait for a lower rank of their word
            for p in positions:
                a = tok[p]
                if a < 0:
                    continue
                q = after[p]
                b = tok[q]
                if b < 0:
                    continue
                if merged(a << 32 | b) != r:
                    continue
                if p < wait:
                    if r in index:
                        index[r].append(p)
                    else:
                        index[r] = [p]
                        heapq.heappush(heap, r)
                    continue
                nxt = after[q]
                tok[p], tok[q] = r, -2
                after[p] = nxt
                before[nxt] = p
                low = False
                c = tok[nxt]
                if c >= 0:
                    new = merged(r << 32 | c, -1)
                    if new >= 0:
                        low = new < r
                        if new in index:
                            index[new].append(p)
                        else:
                            index[new] = [p]
                            heapq.heappush(heap, new)
                left = before[p]
                if left >= 0:
                    c = tok[left]
                    if c >= 0:
                        new = merged(c << 32 | r, -1)
                        if new >= 0:
                            low = low or new < r
                            if new in index:
                                index[new].append(left)
                            else:
                                index[new] = [left]
                                heapq.heappush(heap, new)
                if low:
                    k = bisect_right(starts, p)
                    wait = starts[k] if k < len(starts) else len(tok)
        left = toks
        alive = left >= 0
        ids, x = left[alive].astype("<u4").tobytes(), 0
        for k, n in zip(todo, (4 * np.add.reduceat(alive, starts)).tolist(), strict=True):
            out[k] = ids[x : x + n]
            x += n
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


#: Marks the segment that begins a text; the others follow a space, which they leave out. Stands for a space that is no cut.
_FIRST, _INNER = "\x00", "\x01"
_AFTER_SPACE = re.compile(r"(?<=\s) ")


def _prepare(texts: pa.Array) -> pa.Array:
    """Texts to be cut at spaces that follow a character other than white space, where no match of the pattern holds such a place
    inside. A text that holds one of the marks is left out."""
    odd = pc.or_(pc.match_substring(texts, _FIRST), pc.match_substring(texts, _INNER))
    ready = pc.binary_join_element_wise(_FIRST, texts, "")
    close = pc.match_substring_regex(texts, r"[\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] ")
    if pc.any(close).as_py():
        ready = pa.array([_FIRST + _AFTER_SPACE.sub(_INNER, t) if c else r for t, r, c in zip(texts.to_pylist(), ready.to_pylist(), close.to_pylist(), strict=True)], pa.string())
    return pc.if_else(odd, None, ready)


def _text_of(segment: str) -> str:
    text = segment[1:] if segment[:1] == _FIRST else " " + segment
    return text.replace(_INNER, " ") if _INNER in text else text


def _named(match: str) -> str:
    return match[1:].replace(" ", _INNER) if match[0] == " " else _FIRST + match.replace(" ", _INNER)


@lru_cache(maxsize=4)
def tools(path: str, pattern: str) -> tuple[Ranks, SegmentEncoder]:
    """A worker's vocabulary and encoder."""
    import regex

    ranks, find = Ranks.load(path), regex.compile(pattern).findall

    def pieces(segment: str) -> list[str]:
        """The segment's matches, each named as a segment is."""
        return [_named(w) for w in find(_text_of(segment))]

    def encode_all(words: list[str]) -> list[bytes]:
        return ranks.replay([_text_of(w).encode() for w in words])

    def whole(text: str) -> bytes:
        return b"".join(ranks.replay([w.encode() for w in find(text)]))

    return ranks, SegmentEncoder(re.compile("[A-Za-z]+").fullmatch, pieces, encode_all, _prepare, whole)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids`` of each row: the ids of its whole text as little-endian unsigned 32-bit integers.

    Each match of ``pattern`` is encoded by itself, by the ranks in ``path``, without special tokens. Null counts as the
    empty text, which has no ids. Repeated rows give a row each; other columns are ignored. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tools(path, pattern)[1]
        for batch in batches:
            for rows, ids, at in encoded(batch, text_col, encoder):
                yield pa.RecordBatch.from_arrays([rows.column(id_col), _binary(ids, at)], [id_col, "ids"])

    source = docs.select(id_col, text_col)
    return source.mapInArrow(run, source.select(id_col, F.lit(b"").alias("ids")).schema)


def decode(tokens: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, ids_col, decoded``: the bytes that the ids stand for. Null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = tools(path, pattern)[0]
        for batch in batches:
            texts = [ranks.decode(np.frombuffer(x or b"", "<u4")) for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), batch.column(ids_col), pa.array(texts, pa.binary())], [id_col, ids_col, "decoded"])

    source = tokens.select(id_col, ids_col)
    return source.mapInArrow(run, source.withColumn("decoded", F.lit(b"")).schema)


def _binary(ids: np.ndarray, at: np.ndarray) -> pa.BinaryArray:
    return pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((4 * at).astype("i4")), pa.py_buffer(ids.astype("<u4"))])


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of the ids of each text and of what they decode to.

    One worker encodes and decodes, so a task needs one vocabulary.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, encoder = tools(path, pattern)
        for batch in batches:
            for rows, ids, at in encoded(batch, "text", encoder):
                bounds = at.tolist()
                decoded = [ranks.decode(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), _binary(ids, at), pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])

    source = docs.select("doc_id", "text")
    both = source.mapInArrow(run, source.select("doc_id", F.lit(b"").alias("ids"), F.lit(b"").alias("decoded")).schema)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
