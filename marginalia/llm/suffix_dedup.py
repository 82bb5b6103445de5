"""Repeated passages of bytes: each byte covered by a long string that also starts earlier is removed.

Strings of ``LENGTH`` bytes are told apart by windows: of all hashes of ``GRAM`` bytes inside a string the smallest one (the
rightmost of equals) is its fingerprint, so equal strings have equal fingerprints at equal places. First the fingerprints that
occur twice or more anywhere are found; only the strings that own one of these go on, as segments of neighbouring strings.
Equal segments collapse to the earliest, those of frequent fingerprints by a tree over the blocks; the rest meet by fingerprint, are suffix-sorted, and neighbours in that order with
``LENGTH`` bytes in common are equal strings, of which the earliest stays.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import drop_at_end
from .runtime import parts_for, scratch_path, written
from .suffixes import Suffixes

LENGTH = 100
GRAM = 32
#: Bytes of text in a block; longer documents are one block. Hashes are made ``CHUNK`` bytes at a time, so beside them a task holds
#: little more than the text and a row of 32 bytes for each run of strings with one fingerprint, some 35 bytes of text.
BLOCK_BYTES = 2 << 20
#: Bytes whose hashes are made at once.
CHUNK = 1 << 20
#: Text for which there is one group of fingerprints, and one group of segments to sort.
FINGERPRINT_GROUP, SORT_GROUP = 8 << 20, 4 << 20
LEAST_GROUPS = 48
#: A fingerprint that more strings own is told apart further, by what surrounds it.
FREQUENT = 1000
NEAR = 8
_BITS = 21
_NO_ID = (1 << 63) - 1
_SEED = 77


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


_TABLE = np.random.default_rng(_SEED).integers(0, 1 << 63, 256, dtype="u8")
_STEPS = np.random.default_rng(_SEED + 1).integers(0, 1 << 62, 8, dtype="u8") * np.uint64(2) + np.uint64(1)


def gram_hashes(s: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the ``gram`` (a power of two) bytes from each place on."""
    h, width, k = _TABLE[s], 1, 0
    with np.errstate(over="ignore"):
        while width < gram:
            h = h[:-width] * _STEPS[k] + h[width:]
            width, k = width * 2, k + 1
    return _mix(h)


def owners(s: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The strings of ``length`` bytes of the documents in ``s``, in runs that own one fingerprint: ``hash, place of the fingerprint, first
    start, number of starts``. ``ends`` are the documents' ends. No string crosses documents."""
    inside = length - gram + 1
    mask = np.uint64((1 << _BITS) - 1)
    out = []
    n = len(s)
    for x in range(0, max(0, n - length + 1), CHUNK):
        part = s[x : x + CHUNK + length - 1]
        h = gram_hashes(part, gram)
        key = (h & ~mask) | (mask - np.arange(len(h), dtype="u8"))
        low, width = key, 1
        while width * 2 <= inside:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < inside:
            low = np.minimum(low[: len(low) - (inside - width)], low[inside - width :])
        starts = np.arange(len(low))
        valid = starts + x + length <= ends[np.searchsorted(ends, starts + x, side="right")]
        at = (mask - (low & mask)).astype("i8")
        starts, at = starts[valid], at[valid]
        if not len(starts):
            continue
        new = np.ones(len(starts), bool)
        new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(starts)))
        out.append((h[at[first]], at[first] + x, starts[first] + x, counts))
    if not out:
        return np.zeros(0, "u8"), *(np.zeros(0, "i8") for _ in range(3))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))  # type: ignore[return-value]


_BLOCK = "part long, doc_ids binary, sizes binary, bytes binary"


def _blocks(docs: DataFrame) -> DataFrame:
    """Rows of many documents each: their ids, sizes and bytes. ``part`` is different for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, texts, size = TaskContext.get().partitionId() << 20, [], [], 0

        def row() -> pa.RecordBatch:
            arrays = [pa.array([part], pa.int64()), *(pa.array([x], pa.binary()) for x in (np.array(ids, "i8").tobytes(), np.array([len(t) for t in texts], "i8").tobytes(), b"".join(texts)))]
            return pa.RecordBatch.from_arrays(arrays, ["part", "doc_ids", "sizes", "bytes"])

        for batch in batches:
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = (t.as_py() or "").encode()
                ids.append(_NO_ID if i is None else i)
                texts.append(text)
                size += len(text)
                if size >= BLOCK_BYTES or len(ids) >= 1 << 17:
                    yield row()
                    part, ids, texts, size = part + 1, [], [], 0
        if ids:
            yield row()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _BLOCK)


class _Block:
    def __init__(self, row: dict):
        self.part = row["part"]
        self.ids = np.frombuffer(row["doc_ids"], "i8")
        self.ends = np.cumsum(np.frombuffer(row["sizes"], "i8"))
        self.s = np.frombuffer(row["bytes"], "u1")


def _fingerprints(groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = _Block(row)
                h, counts = np.unique(owners(b.s, b.ends)[0], return_counts=True)
                group = (h >> np.uint64(40)) % np.uint64(groups)
                order = np.argsort(group, kind="stable")
                h, counts, group = h[order], counts[order], group[order]
                cuts = np.append(np.flatnonzero(np.diff(group, prepend=group[:1] + np.uint64(1))), len(h))
                spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if len(h) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(group[x]) for x, _ in spans], pa.int64()), pa.array([b.part] * len(spans), pa.int64()), pa.array([h[x:y].tobytes() for x, y in spans], pa.binary()), pa.array([counts[x:y].astype("u4").tobytes() for x, y in spans], pa.binary())],
                    ["group", "part", "hashes", "counts"],
                )

    return run


def _repeated(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of each block's fingerprints those that occur twice or more in all blocks, and of these the frequent ones."""
    hashes = [np.frombuffer(x, "u8") for x in pdf["hashes"]]
    counts = np.concatenate([np.frombuffer(x, "u4") for x in pdf["counts"]]).astype("i8")
    every = np.concatenate(hashes)
    _, of = np.unique(every, return_inverse=True)
    total = np.bincount(of, weights=counts)[of]
    out, x = [], 0
    for part, h in zip(pdf["part"], hashes, strict=True):
        t = total[x : x + len(h)]
        x += len(h)
        if (t > 1).any():
            out.append((part, h[(t > 1) & (t <= FREQUENT)].tobytes(), h[t > FREQUENT].tobytes()))
    return pd.DataFrame(out, columns=["part", "some", "often"])


#: Blocks whose segments of one frequent fingerprint are collapsed at once.
FAN = 32
_SEGMENTS = "sort_group long, part long, head binary, bytes binary, bucket long"
#: A segment: number of bytes, number of starts, document's id, order among rows with that id, first start, place in the block's documents.
_HEAD = np.dtype([("size", "<i4"), ("starts", "<i4"), ("id", "<i8"), ("uid", "<i8"), ("start", "<i8")])
#: A stretch to remove, from its first to behind its last byte.
_CUT = np.dtype([("uid", "<i8"), ("start", "<i8"), ("end", "<i8")])


def _split_frequent(s: np.ndarray, place: np.ndarray, first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments of at most ``NEAR`` starts, with a hash of the bytes that all of their strings hold: equal strings lie equally far before
    their fingerprint, so they fall in like pieces with equal such bytes."""
    import xxhash

    keys, starts, numbers = [], [], []
    for q, a, c in zip(place.tolist(), first.tolist(), counts.tolist(), strict=True):
        x = a
        while x < a + c:
            far = (q - x) // NEAR * NEAR  # strings with the fingerprint from far to far + NEAR - 1 bytes in
            y = min(a + c, q - far + 1)
            core = s[q - far : q - far - NEAR + 1 + LENGTH]
            keys.append(xxhash.xxh3_64_intdigest(core.tobytes(), far))
            starts.append(x)
            numbers.append(y - x)
            x = y
    return np.array(keys, "u8"), np.array(starts, "i8"), np.array(numbers, "i8")


def _collapse(head: np.ndarray, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The earliest segment of each content, and the stretches that the others cover."""
    best: dict[bytes, int] = {}
    order = np.lexsort((head["start"], head["uid"], head["id"]))
    rest = []
    for k in order.tolist():
        if best.setdefault(raw[k], k) != k:
            rest.append(k)
    cut = np.zeros(len(rest), _CUT)
    h = head[rest]
    cut["uid"], cut["start"], cut["end"] = h["uid"], h["start"], h["start"] + h["size"]
    return np.sort(np.fromiter(best.values(), "i8", len(best))), cut


def _merged(cut: np.ndarray) -> np.ndarray:
    """Stretches of each document in order, those that touch or overlap as one."""
    if not len(cut):
        return cut
    cut = cut[np.lexsort((cut["start"], cut["uid"]))]
    document = np.cumsum(np.diff(cut["uid"], prepend=cut["uid"][0]) != 0)
    wide = int(cut["end"].max()) + 1
    reach = np.maximum.accumulate(cut["end"] + document * wide)
    new = np.ones(len(cut), bool)
    new[1:] = cut["start"][1:] + document[1:] * wide > reach[:-1]
    first = np.flatnonzero(new)
    out = cut[first].copy()
    out["end"] = np.maximum.reduceat(cut["end"], first)
    return out


def _parts_of(cut: np.ndarray) -> list[tuple[int, bytes]]:
    cut = _merged(cut)
    part = cut["uid"] >> 17
    cuts = np.append(np.flatnonzero(np.diff(part, prepend=part[:1] - 1)), len(cut))
    return [(int(part[x]), cut[x:y].tobytes()) for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


_SEGMENT_TYPES = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64())


def _by_group(group: np.ndarray, of: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """The groups of some segments, each with its segments in their order."""
    if not len(of):
        return []
    order = of[np.argsort(group[of], kind="stable")]
    cuts = np.flatnonzero(np.diff(group[order])) + 1
    return [(int(group[some[0]]), some) for some in np.split(order, cuts)]


def _packed(head: np.ndarray, raw: list[bytes], some: np.ndarray) -> tuple[bytes, bytes]:
    return head[some].tobytes(), b"".join([raw[k] for k in some.tolist()])


def _unpacked(pdf: pd.DataFrame) -> tuple[np.ndarray, list[bytes]]:
    """All segments of some rows."""
    heads, raw = [np.frombuffer(x, _HEAD) for x in pdf["head"]], []
    for h, x in zip(heads, pdf["bytes"], strict=True):
        ends = np.cumsum(h["size"].astype("i8")).tolist()
        raw += [x[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    return np.concatenate(heads), raw


def _collapsed_group(pdf: pd.DataFrame) -> pd.DataFrame:
    """The segments of some blocks, equal ones as the earliest, and the stretches that the others cover."""
    head, raw = _unpacked(pdf)
    keep, cut = _collapse(head, raw)
    group, bucket = pdf["sort_group"].iloc[0], pdf["bucket"].iloc[0]
    rows = [(group, -1, *_packed(head, raw, keep), bucket)] + [(group, p, x, b"", -1) for p, x in _parts_of(cut)]
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _SEGMENTS.split(", ")])


def _collapsed(segments: DataFrame, buckets: int) -> DataFrame:
    """``segments`` whose frequent ones are collapsed by ever larger sets of blocks, ``FAN`` at a time: a passage that very many blocks hold meets its
    copies in a tree, and at the end once for each of its contents."""
    out = written(segments, "segments", compression="zstd")
    while buckets > 1:
        buckets = -(-buckets // FAN)
        hot = out.where("bucket >= 0").withColumn("bucket", F.pmod("bucket", F.lit(buckets)).cast("long"))
        met = hot.groupBy("sort_group", "bucket").applyInPandas(_collapsed_group, _SEGMENTS)
        out = written(out.where("bucket < 0").unionByName(met), "segments", compression="zstd")
    return out


def _segments(groups: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = _Block(row)
                some, often = (np.sort(np.frombuffer(b"".join(row[c]), "u8")) for c in ("some", "often"))
                h, place, first, counts = owners(b.s, b.ends)

                def among(x: np.ndarray, h: np.ndarray = h) -> np.ndarray:
                    return x[np.minimum(np.searchsorted(x, h), len(x) - 1)] == h if len(x) else np.zeros(len(h), bool)

                a, f = among(some), among(often)
                fk, fs, fn = _split_frequent(b.s, place[f], first[f], counts[f])
                key, start, number = np.concatenate([h[a], fk]), np.concatenate([first[a], fs]), np.concatenate([counts[a], fn])
                doc = np.searchsorted(b.ends, start, side="right")
                head = np.zeros(len(key), _HEAD)
                begin = np.concatenate([[0], b.ends])[doc]
                head["size"], head["starts"], head["id"], head["uid"], head["start"] = number + LENGTH - 1, number, b.ids[doc], (b.part << 17) + doc, start - begin
                whole = row["bytes"]
                raw = [whole[x:y] for x, y in zip(start.tolist(), (start + head["size"]).tolist(), strict=True)]
                keep, cut = _collapse(head, raw)
                frequent = np.arange(len(key))[keep] >= int(a.sum())
                head, key, raw = head[keep], key[keep], [raw[k] for k in keep.tolist()]
                group = ((key >> np.uint64(40)) % np.uint64(groups)).astype("i8")
                bucket = b.part * 2654435761 % buckets
                rows = [(g, -1, *_packed(head, raw, some), bucket if hot else -1) for hot, here in ((False, ~frequent), (True, frequent)) for g, some in _by_group(group, np.flatnonzero(here))]
                rows += [(int(p % groups), p, x, b"", -1) for p, x in _parts_of(cut)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(_SEGMENT_TYPES)], [c.split()[0] for c in _SEGMENTS.split(", ")])

    return run


def _sorted_group(pdf: pd.DataFrame) -> pd.DataFrame:
    """The stretches to remove that a group of segments shows, by block; stretches found before pass through."""
    done = pdf["part"] >= 0
    out = list(zip(pdf["part"][done], pdf["head"][done], strict=True))
    if not done.all():
        head, raw = _unpacked(pdf[~done])
        keep, cut = _collapse(head, raw)
        head = head[keep]
        s = np.frombuffer(b"".join([raw[k] for k in keep.tolist()]), "u1")
        size, starts = head["size"].astype("i8"), head["starts"].astype("i8")
        ends = np.cumsum(size)
        inner = np.arange(len(s)) - np.repeat(ends - size, size)
        suffixes = Suffixes(s, ends, LENGTH)
        at = suffixes.order(inner < np.repeat(starts, size))
        run = np.cumsum(suffixes.common(at) < LENGTH)
        of = np.repeat(np.arange(len(head)), size)[at]
        start = head["start"][of] + inner[at]
        order = np.lexsort((start, head["uid"][of], head["id"][of], run))
        later = np.zeros(len(order), bool)
        later[1:] = run[order][1:] == run[order][:-1]
        late = order[later]
        more = np.zeros(len(late), _CUT)
        more["uid"], more["start"], more["end"] = head["uid"][of[late]], start[late], start[late] + LENGTH
        out += _parts_of(np.concatenate([_merged(cut), more]))
    return pd.DataFrame(out, columns=["part", "cuts"])


_RESULT = "doc_id long, n_bytes long, removed array<long>, kept binary"


def _cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            b = _Block(row)
            cut = _merged(np.concatenate([np.frombuffer(x, _CUT) for x in row["cuts"] or []] or [np.zeros(0, _CUT)]))
            doc = cut["uid"] - (b.part << 17)
            bounds = np.searchsorted(doc, np.arange(len(b.ids) + 1))
            begin = np.concatenate([[0], b.ends]).tolist()
            spans = np.stack([cut["start"], cut["end"]], axis=1)
            removed, kept = [], []
            for k in range(len(b.ids)):
                text, mine = row["bytes"][begin[k] : begin[k + 1]], spans[bounds[k] : bounds[k + 1]].ravel().tolist()
                removed.append(mine)
                edges = [0, *mine, len(text)]
                kept.append(b"".join([text[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)]))
            ids = pa.array([None if i == _NO_ID else i for i in b.ids.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(begin)), pa.array(removed, pa.list_(pa.int64())), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "removed", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, removed, kept`` of each row of ``docs`` (``doc_id``, ``text``).

    A text counts as its UTF-8 bytes, null as none. Every byte covered by a string of 100 bytes that also starts earlier, in a row
    with a smaller id or further left in the same row, is removed; what is repeated is judged on the input. ``removed`` lists the starts
    and ends of the maximal removed runs, ``kept`` is the rest. Null ids come last; rows that share an id count as different
    documents in an order of their own; an empty table gives none; other columns are ignored.
    """
    spark = docs.sparkSession
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    files = parts_for(total, 4 * BLOCK_BYTES, 12)
    path = scratch_path(spark, "blocks")
    name = f"blocks_{uuid.uuid4().hex}"
    _blocks(docs).repartition(files, "part").write.bucketBy(files, "part").option("path", path).option("compression", "zstd").saveAsTable(name)
    drop_at_end(spark, name)
    blocks = spark.table(name)  # in buckets by part, so that joins by part leave the texts where they are
    groups = parts_for(total, FINGERPRINT_GROUP, LEAST_GROUPS)
    prints = blocks.mapInArrow(_fingerprints(groups), "group long, part long, hashes binary, counts binary")
    found = prints.groupBy("group").applyInPandas(_repeated, "part long, some binary, often binary")
    found = written(found.groupBy("part").agg(F.collect_list("some").alias("some"), F.collect_list("often").alias("often")), "repeated")
    groups = parts_for(total, SORT_GROUP, LEAST_GROUPS)
    buckets = parts_for(total, BLOCK_BYTES)
    segments = _collapsed(blocks.join(found, "part").mapInArrow(_segments(groups, buckets), _SEGMENTS), buckets)
    cuts = segments.groupBy("sort_group").applyInPandas(_sorted_group, "part long, cuts binary")
    cuts = written(cuts.groupBy("part").agg(F.collect_list("cuts").alias("cuts")), "cuts")
    return blocks.join(cuts, "part", "left").mapInArrow(_cut_blocks, _RESULT)


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of what ``remove_repeats`` leaves."""
    out = remove_repeats(docs)
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), (F.size("removed") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
