"""Groups of spelling variants by anagram hashing: words whose letter sums differ by one letter's value, verified in letter order."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.graph import ends
from .runtime import written

SHORTEST = 5
FEWEST = 3
#: A form has so many times the occurrences of its variant.
TIMES = 2
#: One (document, word) in so many loses a letter, as the contract says.
DAMAGED = 97
#: Sums of fifth powers are kept below this Mersenne prime, so words of any length have a key.
MODULUS = (1 << 61) - 1
#: Characters of the texts whose words are counted together, about.
TOGETHER = 8_000_000
#: Words with more bytes have their check sums taken one by one.
_TABLED = 64

#: Each byte of a text in Latin-1: A to Z lower-cased, a to z and U+00C0 to U+00FF as they are, all others 0.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 0 for c in range(256))


class _Sums:
    """Check sums of ``<doc_id>:<word>``. A check sum is affine in the one before it, so that of a document is carried over a word by a
    table of the word's length and meets the word's own."""

    def __init__(self, ids: list[int | None]):
        self.base = [zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids]
        self.carried: dict[int, np.ndarray] = {}

    def over(self, length: int) -> np.ndarray:
        if length not in self.carried:
            zeros = bytes(length)
            none = zlib.crc32(zeros)
            self.carried[length] = np.array([zlib.crc32(zeros, b) ^ none for b in self.base], "u4")
        return self.carried[length]


def _counted(ids: list[int | None], texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The words of some texts after damage, and their numbers."""
    s = np.frombuffer(b"\0".join(t.encode("latin-1", "replace").translate(_LETTERS) for t in texts), "u1")
    letter = np.concatenate(([False], s != 0, [False]))
    edge = np.flatnonzero(letter[1:] != letter[:-1])
    starts, stops = edge[::2], edge[1::2]
    if not len(starts):
        return [], np.zeros(0, "i8")
    offsets = np.concatenate(([0], np.cumsum(stops - starts))).astype("i8")
    runs = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(s[s != 0].tobytes())]).dictionary_encode()
    of = runs.indices.to_numpy()
    words = [w.decode("latin-1") for w in runs.dictionary.to_pylist()]
    raw = [w.encode() for w in words]
    own, size = np.array([zlib.crc32(w) for w in raw], "u4"), np.array([len(w) for w in raw], "i8")
    begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    doc = np.searchsorted(begins, starts, side="right") - 1
    sums, sizes, hashes = _Sums(ids), size[of], np.zeros(len(of), "u4")
    for length in np.unique(sizes):
        at = np.flatnonzero(sizes == length)
        if length <= _TABLED:
            hashes[at] = sums.over(int(length))[doc[at]] ^ own[of[at]]
        else:
            hashes[at] = [zlib.crc32(raw[of[k]], sums.base[doc[k]]) for k in at]
    hit = np.flatnonzero(hashes % DAMAGED == 0)
    counts = np.bincount(of, minlength=len(words)) - np.bincount(of[hit], minlength=len(words))
    damaged: dict[str, int] = {}
    for k in hit:
        w = words[of[k]]
        cut = int(hashes[k]) % len(w)
        w = w[:cut] + w[cut + 1 :]
        damaged[w] = damaged.get(w, 0) + 1
    return words + list(damaged), np.concatenate((counts, np.fromiter(damaged.values(), "i8", len(damaged))))


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` of every run of letters in the whole texts of ``docs`` (``doc_id``, ``text``), of any length and number, after damage.

    Null and empty texts have none. A null id counts as an empty one. Sums are taken by block of texts before they are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block() -> pa.RecordBatch:
            words, n = _counted(ids, texts)
            some = n > 0
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()).filter(pa.array(some)), pa.array(n[some])], ["word", "n"])

        ids, texts, size = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                t = t.as_py()
                if t:
                    ids.append(i)
                    texts.append(t)
                    size += len(t)
                if size > TOGETHER:
                    yield block()
                    ids, texts, size = [], [], 0
        if texts:
            yield block()

    source = docs.select(F.col("doc_id").cast("long"), "text")
    return source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _power(letter: Column) -> Column:
    code = F.ascii(letter).cast("long")
    return code * code * code * code * code


def _less(key: Column, power: Column) -> Column:
    return F.pmod(key - power, F.lit(MODULUS))


def with_keys(words: DataFrame) -> DataFrame:
    """``words`` with their ``letters`` and ``key``: the sum of the letters' powers, the same for all anagrams."""
    letters = words.withColumn("letters", F.split("word", ""))
    return letters.withColumn("key", F.aggregate("letters", F.lit(0).cast("long"), lambda total, c: F.pmod(total + _power(c), F.lit(MODULUS))))


def joined_keys(keyed: DataFrame) -> DataFrame:
    """``meet``: keys less one letter's value that two keys have, or that are a key themselves.

    Keys that differ by a value added or removed meet in the smaller one; keys that differ by an exchange of values meet in what both
    are without them. Only the least and the largest key are kept for each, so anagrams and frequent letters make no lists.
    """
    keys = keyed.groupBy("key").agg(F.first("letters").alias("letters"))
    less = keys.select("key", F.explode(F.array_distinct("letters")).alias("c")).select("key", _less(F.col("key"), _power(F.col("c"))).alias("meet"))
    every = less.unionByName(keys.select("key", F.col("key").alias("meet")))
    return every.groupBy("meet").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a < b").select("meet")


def near_words(keyed: DataFrame) -> DataFrame:
    """``word, n_near, best`` of each of ``keyed`` that has a near word; ``best``: number (negative) and word of the near word of largest n.

    Words come together by the keys that ``joined_keys`` joins, and inside a key by what is left in its order: two words of one
    length without the same place, or a word and a longer one without a place. So many words can be left the same as
    there are letters and places, whatever the table holds; each counts the others without any pair being made.
    """
    places = keyed.select("word", "n", "key", "letters", F.posexplode("letters").alias("at", "c"))
    first = (F.col("at") == 0) | (F.element_at("letters", F.greatest("at", F.lit(1))) != F.col("c"))  # of equal letters side by side, one counts as removed
    rest = F.concat(F.expr("substring(word, 1, at)"), F.expr("substring(word, at + 2)"))
    less = places.select(_less(F.col("key"), _power(F.col("c"))).alias("meet"), rest.alias("rest"), "at", first.alias("removed"), F.struct((-F.col("n")).alias("less"), "word").alias("w"))
    whole = keyed.select(F.col("key").alias("meet"), F.col("word").alias("rest"), F.lit(-1).alias("at"), F.lit(False).alias("removed"), F.struct((-F.col("n")).alias("less"), "word").alias("w"))
    posts = less.unionByName(whole).join(joined_keys(keyed).hint("merge"), "meet", "left_semi")
    same = Window.partitionBy("meet", "rest")
    place = Window.partitionBy("meet", "rest", "at").orderBy("w").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shorter, is_whole = F.min(F.when(F.col("at") == -1, F.col("w"))).over(same), F.col("at") == -1
    top, second = F.first("w").over(place), F.nth_value("w", 2).over(place)
    seen = posts.select(
        "w", "at", "removed", F.count("*").over(place).alias("in_place"), F.when(top == F.col("w"), second).otherwise(top).alias("exchanged"),
        shorter.alias("shorter"), F.count_if("removed").over(same).alias("longer"), F.min(F.when(F.col("removed"), F.col("w"))).over(same).alias("most"),
    )
    removed = F.col("removed") & F.col("shorter").isNotNull()
    n = F.when(is_whole, F.col("longer")).otherwise(F.col("in_place") - 1 + removed.cast("long"))
    best = F.when(is_whole, F.col("most")).otherwise(F.least("exchanged", F.when(removed, F.col("shorter"))))
    found = seen.select(F.col("w.word").alias("word"), n.alias("n"), best.alias("best")).where("n > 0")
    return found.groupBy("word").agg(F.sum("n").alias("n_near"), F.min("best").alias("best"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each word of five letters or more that occurs three times or more in ``docs``.

    Words are near if one letter added, removed or exchanged makes one the other. A word's ``form`` is its near word of largest n, of
    those the smallest in code-point order, if it occurs at least twice as often; ``root`` is the last of its forms, found by doubling
    steps. Null and empty texts hold no words; a null ``doc_id`` counts as empty; rows may repeat, and then count again; runs of letters may
    have any length; an empty table gives no rows; other columns are ignored.
    """
    words = word_counts(docs).where((F.length("word") >= SHORTEST) & (F.col("n") >= FEWEST))
    keyed = written(with_keys(words), "words")
    near = near_words(keyed)
    form_n = -F.col("best.less")
    formed = form_n >= TIMES * F.col("n")
    out = keyed.select("word", "n").join(near.hint("merge"), "word", "left")
    out = written(out.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(formed, F.col("best.word")).alias("form"), F.when(formed, form_n).alias("form_n")), "forms")
    last = ends(out.where("form IS NOT NULL").select(F.col("word").alias("node"), F.col("form").alias("to")))
    out = out.join(last.withColumnRenamed("node", "word").hint("merge"), "word", "left")
    return out.select("word", "form", F.coalesce("end", "word").alias("root"), "n", "n_near", "form_n")
