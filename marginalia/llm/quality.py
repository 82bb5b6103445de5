"""Host-level quality rules with shrunken failure rates (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import salt, salted_join
from .runtime import let, words, written

#: Fixed values of the base rules.
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = r"[#*$%&|<>]"
#: A host goes when its failure rate is above this with the posterior's certainty.
HOST_BAD_RATE = 0.5
#: Standard deviations of the posterior that must lie above the rate: one-sided, 95 %.
CERTAIN = 1.645
#: Bounds of the prior's weight, in documents.
PRIOR_LEAST, PRIOR_MOST = 1.0, 1e6


def _covered(h: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more; ``h``: the windows' hashes in order of position."""

    def dup_positions(s: Column) -> Column:
        same = lambda j, k: F.get(s, j)["x"] == F.get(s, k)["x"]
        twice = F.filter(s, lambda _, j: F.coalesce(same(j, j + 1), F.lit(False)) | (F.coalesce((j > 0) & same(j, j - 1), F.lit(False))))
        return F.array_sort(F.transform(twice, lambda t: t["i"]))

    def total(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    keyed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    return let(let(keyed, dup_positions), total)


def repeat_words(w: Column) -> Column:
    """Words that lie in a window of eight words found twice or more in the text, first occurrence included.

    Windows are compared by a 64-bit hash: for a text of n words the chance of any false match is below n*n / 2**65.
    """
    hashes = lambda v: F.when(
        F.size(v) >= WINDOW, F.transform(F.sequence(F.lit(1), F.size(v) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(v, i, WINDOW)))
    )
    return let(w, lambda v: let(hashes(v), lambda h: F.when(h.isNull() | (F.size(F.array_distinct(h)) == F.size(h)), F.lit(0).cast("long")).otherwise(_covered(h))))


def text_features(text: Column) -> Column:
    """A struct of the five counts of a text; null and empty texts have zeros."""
    t = F.coalesce(text, F.lit(""))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"),
        )

    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    dup = let(lines, lambda v: (F.size(v) - F.size(F.array_distinct(v))).cast("long"))
    return F.struct(let(words(t), of_words).alias("w"), F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"), dup.alias("n_dup_lines"))


def base_failed(text: Column) -> Column:
    """Whether a text fails the base rules; null and empty ones do."""
    return let(words(text), lambda w: (F.size(w) < MIN_WORDS) | (100 * repeat_words(w) > MAX_REPEAT_PERCENT * F.size(w)))


def base_rules(docs: DataFrame, *carry: str) -> DataFrame:
    """The counts and ``base_failed`` of each row, beside the columns ``carry``. One pass, no shuffle."""
    f = docs.select(*carry, text_features(F.col("text")).alias("f"))
    f = f.select(*carry, "f.w.n_words", "f.w.word_chars", "f.n_symbols", "f.n_dup_lines", "f.w.n_repeat_words")
    return f.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def host_verdicts(rows: DataFrame, host: str, bad_rate: float = HOST_BAD_RATE) -> DataFrame:
    """``host, host_docs, host_failed, host_rate, host_rejected`` from rows that have ``host`` and ``base_failed``.

    Failures are summed by host before the shuffle. A beta prior is fitted to the hosts' rates by moments: mean m is the
    rate of all documents, and the variance between hosts is the weighted variance of the rates less what the binomial
    explains. A host's rate is the posterior's mean (failed + m k) / (docs + k), k = m (1 - m) / variance - 1. It is rejected
    when that lies above ``bad_rate`` by ``CERTAIN`` standard deviations of its posterior or more: a host of few documents needs
    a prior that makes such rates likely, and where hosts do not differ none goes. Rows without host have no verdict.
    """
    hosts = rows.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(F.count("*").alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failed"))
    d, f = F.col("host_docs"), F.col("host_failed")
    sums = hosts.agg(F.sum(d).cast("double").alias("n"), F.sum(f).cast("double").alias("t"), F.count("*").cast("double").alias("h"), F.sum(f.cast("double") * f / d).alias("q"))
    m = F.col("t") / F.col("n")
    spread = F.col("q") / F.col("n") - m * m - m * (1 - m) * F.col("h") / F.col("n")
    k = F.when((m <= 0) | (m >= 1), F.lit(PRIOR_LEAST)).when(spread <= 0, F.lit(PRIOR_MOST)).otherwise(F.greatest(F.lit(PRIOR_LEAST), F.least(F.lit(PRIOR_MOST), m * (1 - m) / spread - 1)))
    prior = sums.where("n > 0").select(m.alias("m"), k.alias("k"))
    rated = hosts.crossJoin(F.broadcast(prior))  # the prior is one row
    weight = d + F.col("k")
    rate = (f + F.col("m") * F.col("k")) / weight
    rated = rated.select("host", "host_docs", "host_failed", rate.alias("host_rate"), weight.alias("w"))
    sure = F.col("host_rate") - CERTAIN * F.sqrt(F.col("host_rate") * (1 - F.col("host_rate")) / (F.col("w") + 1))
    return rated.select("host", "host_docs", "host_failed", "host_rate", (sure > bad_rate).alias("host_rejected"))


def quality(docs: DataFrame, host: str = "source", bad_rate: float = HOST_BAD_RATE) -> DataFrame:
    """Quality counts and verdict of each row of ``docs`` (``doc_id``, ``text``, ``host``).

    A row is kept if it passes the base rules and its host is not rejected. Null and empty texts have no words and fail;
    rows without host follow the base rules alone; repeated rows give a row each; an empty table gives none. Other
    columns are ignored. The texts are read once: the counts are written before hosts are summed and joined. A host's rows
    are dealt to pieces that meet its verdict, so a host with most of the rows is no one task's.
    """
    f = base_rules(docs.select("doc_id", F.col(host).alias("host"), "text"), "doc_id", "host")
    f = written(f.withColumn("rid", F.monotonically_increasing_id()), "quality")
    v = host_verdicts(f, "host", bad_rate).select("host", "host_rejected")
    out = salted_join(f, v, ["host"], F.col("rid"), "left")
    rejected = F.coalesce(F.col("host_rejected"), F.lit(False))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~rejected).alias("kept"))


def keep_good(docs: DataFrame, host: str = "source", bad_rate: float = HOST_BAD_RATE) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns.

    Rows are judged in place, so ids need not be unique. The base rules run once: rows are written with their verdict and a piece that
    they are dealt to, hosts are summed from these columns alone, and the rows that pass are read again without the pieces
    of rejected hosts. Those are written first, so that the planner knows their size: few are sent to all tasks, many meet the rows by
    host and piece.
    """
    failed, piece, gone = "__base_failed", "__piece", "__rejected_host"
    judged = docs.withColumns({failed: base_failed(F.col("text")), piece: salt(F.monotonically_increasing_id())})
    judged = written(judged, "judged", compression="zstd")
    rows = judged.select(F.col(host).alias("host"), F.col(piece).alias("piece"), F.col(failed).alias("base_failed"))
    rejected = host_verdicts(rows, "host", bad_rate).where("host_rejected").select("host")
    pieces = written(rows.select("host", "piece").distinct().join(rejected, "host").toDF(gone, "__p"), "rejected_hosts")
    out = judged.where(~F.col(failed)).join(pieces, (F.col(host) == F.col(gone)) & (F.col(piece) == F.col("__p")), "left_anti")
    return out.drop(failed, piece)
