"""Packing of documents into sequences by minimum bin slack."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .runtime import parts_for, written
from .segments import encoded
from .words import ended, word_encoder

CAPACITY = 4096
#: Documents whose ranks one task counts, about.
SALT_ROWS = 100_000
LEAST_SALTS = 256


@dataclass(frozen=True)
class Slot:
    """Where the pieces [offset, offset + length) of the documents with ranks [low, high) of a class of rests go: item j = first +
    rank - low lies in sequence ``sequence + j // copies``, at ``at + j % copies * length``."""

    rest: int
    low: int
    high: int
    offset: int
    length: int
    first: int
    copies: int
    sequence: int
    at: int


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, of which ``counts`` are left, whose sum is closest to ``room`` from below.

    Subset sums are bits of an integer; each length enters in powers of two of its copies, longest first, until ``room``
    itself is reached. The chosen counts are traced back through the bits as they were before each step.
    """
    bits, steps, full = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, step = min(counts[length], room // length), 1
        while left and not bits >> room & 1:
            take = min(step, left)
            steps.append((length, take, bits))
            bits |= bits << (length * take) & full
            left, step = left - take, step * 2
        if bits >> room & 1:
            break
    at, chosen = bits.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Slot], int]:
    """Slots for ``counts[length]`` rests of each length below ``capacity``, and the number of sequences.

    Each window takes the longest rest left and the fill closest to what remains of it, as often as the counts allow. A
    window with slack is filled up by the head of the longest rest left; its tail goes back to the pool. What cannot fill a
    window at the end is cut into powers of two, which need no padding. The size of the plan is bounded by the number of
    lengths, not of documents.
    """
    pool = {n: deque([(n, 0, c, 0)]) for n, c in counts.items() if c > 0 and n > 0}
    left = {n: c for n, c in counts.items() if c > 0 and n > 0}
    slots: list[Slot] = []
    sequences = 0

    def take(length: int, n: int) -> list[tuple[int, int, int, int]]:
        out = []
        left[length] -= n
        while n:
            rest, low, c, offset = pool[length].popleft()
            k = min(c, n)
            out.append((rest, low, k, offset))
            if k < c:
                pool[length].appendleft((rest, low + k, c - k, offset))
            n -= k
        if not left[length]:
            del left[length], pool[length]
        return out

    def place(items: list[tuple[int, int, int, int]], length: int, copies: int, sequence: int, at: int) -> None:
        first = 0
        for rest, low, c, offset in items:
            slots.append(Slot(rest, low, low + c, offset, length, first, copies, sequence, at))
            first += c

    def back(items: list[tuple[int, int, int, int]], cut: int) -> None:
        for rest, low, c, offset in items:
            tail = rest - offset - cut
            left[tail] = left.get(tail, 0) + c
            pool.setdefault(tail, deque()).append((rest, low, c, offset + cut))

    while left:
        longest = max(left)
        left[longest] -= 1
        fill = best_fill({n: c for n, c in left.items() if c}, capacity - longest)
        left[longest] += 1
        fill[longest] = fill.get(longest, 0) + 1
        slack = capacity - sum(n * c for n, c in fill.items())
        spare = {n: c - fill.get(n, 0) for n, c in left.items() if n > slack and c > fill.get(n, 0)}
        if slack and not spare:
            break  # everything left lies in this window
        times = min(left[n] // c for n, c in fill.items())
        cut = max(spare) if slack else 0
        if slack:
            need = fill.get(cut, 0) + 1
            times = min(times, left[cut] // need)
        at = 0
        for n, c in sorted(fill.items(), reverse=True):
            place(take(n, c * times), n, c, sequences, at)
            at += n * c
        if slack:
            items = take(cut, times)
            place(items, slack, 1, sequences, at)
            back(items, slack)
        sequences += times
    tail = [(n, item) for n in sorted(left, reverse=True) for item in pool[n]]
    todo = sum(n * item[2] for n, item in tail)
    room, at = 1 << max(0, todo.bit_length() - 1), 0
    for n, (rest, low, c, offset) in tail:
        for rank in range(low, low + c):
            done = 0
            while done < n:
                k = min(n - done, room - at)
                slots.append(Slot(rest, rank, rank + 1, offset + done, k, 0, 1, sequences, at))
                done, at, todo = done + k, at + k, todo - k
                if at == room:
                    sequences, at = sequences + 1, 0
                    room = 1 << max(0, todo.bit_length() - 1)
    return slots, sequences


_ENCODED = "doc_id long, doc_tokens long, rest long, rest_crc32 long, full_crc32 array<long>, rest_ids binary"


def _encode(docs: DataFrame, tokenizer: str, capacity: int) -> DataFrame:
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        for batch in batches:
            for rows, ids, at in encoded(batch, "text", encoder):
                ids, at = ended(ids, at)
                raw, at = memoryview(ids.astype("<u4")).cast("B"), (4 * at).tolist()
                texts = [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
                rest = [bytes(x[len(x) // width * width :]) for x in texts]
                full = [[zlib.crc32(x[a : a + width]) for a in range(0, len(x) // width * width, width)] for x in texts]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array([len(x) // 4 for x in texts], pa.int64()), pa.array([len(x) // 4 for x in rest], pa.int64()), pa.array([zlib.crc32(x) for x in rest], pa.int64()), pa.array(full, pa.list_(pa.int64())), pa.array(rest, pa.binary())],
                    ["doc_id", "doc_tokens", "rest", "rest_crc32", "full_crc32", "rest_ids"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _ENCODED)


def _ranked(rows: DataFrame, salts: int) -> DataFrame:
    """``rank`` of each row among those of its rest, and ``fulls``, the full windows of all rows before.

    Rows are dealt to salts by a hash of their place, so a class that holds a third of all rows is counted by many tasks;
    sums by salt give each salt its first rank.
    """
    keyed = rows.select("rid", "doc_id", "doc_tokens", "rest", "rest_crc32", "full_crc32", F.size("full_crc32").cast("long").alias("n_full"), F.pmod(F.xxhash64("rid"), F.lit(salts)).alias("salt"))
    before = lambda *keys: Window.partitionBy(*keys).orderBy("rid").rowsBetween(Window.unboundedPreceding, -1)
    local = keyed.withColumn("fulls", F.coalesce(F.sum("n_full").over(before("salt")), F.lit(0))).withColumn("rank", F.row_number().over(Window.partitionBy("salt", "rest").orderBy("rid")) - 1)
    by_class = keyed.groupBy("salt", "rest").agg(F.count("*").alias("c"))
    up_to = Window.partitionBy("rest").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    by_class = by_class.select("salt", "rest", F.coalesce(F.sum("c").over(up_to), F.lit(0)).alias("class_before"))
    by_salt = keyed.groupBy("salt").agg(F.sum("n_full").alias("c"))
    over = Window.orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)  # a row for each salt
    by_salt = by_salt.select("salt", F.coalesce(F.sum("c").over(over), F.lit(0)).alias("fulls_before"))
    out = local.join(by_class, ["salt", "rest"]).join(by_salt, "salt")
    return out.withColumn("rank", F.col("rank") + F.col("class_before")).withColumn("fulls", F.col("fulls") + F.col("fulls_before"))


def _slots_frame(spark: SparkSession, slots: list[Slot], counts: dict[int, int]) -> tuple[DataFrame, DataFrame]:
    """Slots by ranges of ranks (``rest, bucket``), and the width of the ranges of each rest.

    The width is what a rest's documents and slots make on average, so slots lie in twice their number of ranges at most, and a
    document meets about two of them, however many slots its rest has.
    """
    many: dict[int, int] = {}
    for s in slots:
        many[s.rest] = many.get(s.rest, 0) + 1
    width = {rest: max(1, -(-counts[rest] // n)) for rest, n in many.items()}
    rows = [(s.rest, k, s.low, s.high, s.offset, s.length, s.first, s.copies, s.sequence, s.at) for s in slots for k in range(s.low // width[s.rest], (s.high - 1) // width[s.rest] + 1)]
    schema = "rest long, bucket long, low long, high long, offset long, length long, first long, copies long, sequence long, at long"
    return F.broadcast(spark.createDataFrame(rows, schema)), F.broadcast(spark.createDataFrame(sorted(width.items()), "rest long, width long"))


def _crc_of_cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, offset, length = (batch.column(c).to_pylist() for c in ("rest_ids", "piece_offset", "length"))
        sums = [zlib.crc32(x[4 * o : 4 * (o + n)]) for x, o, n in zip(ids, offset, length, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in _PIECE] + [pa.array(sums, pa.int64())], [*_PIECE, "ids_crc32"])


_PIECE = ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents of ``docs`` (``doc_id``, ``text``) in sequences of at most ``capacity`` ids.

    A document's ids, ended by the id ``END``, are cut into full windows, each a sequence of its own, and a rest; the rests are
    packed by their lengths, of which there are fewer than ``capacity``, so the plan is made on the driver and sent to all
    tasks whatever the number of documents. Columns: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.
    Null counts as the empty text, whose only id is ``END``; rows that share an id are documents of their own; an empty table
    gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = written(_encode(docs, tokenizer, capacity).withColumn("rid", F.monotonically_increasing_id()), "rests", compression="zstd")
    counts = {r["rest"]: r["n"] for r in rows.groupBy("rest").agg(F.count("*").alias("n")).collect()}  # below capacity rows
    slots, sequences = plan(counts, capacity)
    ranked = _ranked(rows, parts_for(sum(counts.values()), SALT_ROWS, LEAST_SALTS))
    whole = ranked.select("doc_id", "doc_tokens", "fulls", F.posexplode("full_crc32").alias("k", "ids_crc32")).select(
        "doc_id", (F.col("k") * capacity).cast("long").alias("start"), F.lit(capacity).cast("long").alias("length"), "doc_tokens", (F.lit(sequences) + F.col("fulls") + F.col("k")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "ids_crc32"
    )
    plan_rows, widths = _slots_frame(spark, slots, counts)  # bounded by the number of lengths
    ranged = ranked.join(widths, "rest").withColumn("bucket", F.floor(F.col("rank") / F.col("width")).cast("long"))
    met = ranged.join(plan_rows, ["rest", "bucket"]).where((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    j = F.col("first") + F.col("rank") - F.col("low")
    piece = met.select(
        "rid", "rest", "rest_crc32", F.col("offset").alias("piece_offset"), "doc_id", (F.col("doc_tokens") - F.col("rest") + F.col("offset")).alias("start"), "length", "doc_tokens",
        (F.col("sequence") + F.floor(j / F.col("copies"))).cast("long").alias("sequence_id"), (F.col("at") + F.pmod(j, F.col("copies")) * F.col("length")).alias("offset"),
    )
    uncut = F.col("length") == F.col("rest")
    kept = piece.where(uncut).select(*_PIECE, F.col("rest_crc32").alias("ids_crc32"))
    cut = piece.where(~uncut).join(rows.select("rid", "rest_ids"), "rid").select(*_PIECE, "piece_offset", "rest_ids")
    cut = cut.mapInArrow(_crc_of_cut, cut.select(*_PIECE, F.lit(0).cast("long").alias("ids_crc32")).schema)
    return whole.unionByName(kept).unionByName(cut).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
