"""Golden records: one record of each cluster of client records, its fields chosen by lexicographic elimination."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import SALTS
from .runtime import written

#: Sources by falling trust; all others, and none, come after them.
TRUST = ("crm", "web", "store", "partner")
STALE_HOURS = 60 * 24
_BLANK = r"^[\x20\x09-\x0D]*$"
_LAST = (1 << 63) - 1
#: A cluster: its id, and whether it has none. A group of candidates: those of a cluster for a field.
_CLUSTER = ("cluster", "nameless")
_GROUP = (*_CLUSTER, "field")
_PIECE = "__salt"


def _text(column: str) -> Column:
    return F.when(~F.col(column).rlike(_BLANK), F.col(column))


def _micros(column: str, kind: T.DataType) -> Column:
    """Microseconds since 1970 of a time, whatever the session's time zone."""
    if not isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(column).cast("timestamp"))
    since = F.col(column) - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    parts = [("DAY", 86_400_000_000), ("HOUR", 3_600_000_000), ("MINUTE", 60_000_000), ("SECOND", 1_000_000)]
    return sum((F.extract(F.lit(unit), since) * F.lit(micros) for unit, micros in parts), F.lit(0)).cast("long")


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.withColumn(_PIECE, F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int"))


def _beside(rows: DataFrame, per_key: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Dealt ``rows`` beside the one row of their ``keys``: it goes to the pieces that exist and from there to their rows, so no key is one
    task's; joins are sorted merges, so nothing is sent to all tasks."""
    pieces = rows.groupBy(*keys, _PIECE).agg(F.lit(1).alias("__one")).drop("__one")
    return rows.join(pieces.join(per_key.hint("merge"), keys).hint("merge"), [*keys, _PIECE], how).drop(_PIECE)


def survivors(candidates: DataFrame, rounds: int) -> DataFrame:
    """``cluster, nameless, field, value, client_id`` of the candidate of each group whose ``criteria`` come first in order.

    ``criteria`` is an array of numbers, the least of which is best. In each round the best next criterion of every group is
    aggregated, by pieces and then whole, and candidates are semi-joined with it, until each group has one. Groups of one leave
    at once. Every round is written, so a lost executor costs that round's tasks. Candidates that are alike in all criteria repeat
    a record's id: the least ``value`` stays.
    """
    group, out = list(_GROUP), ["value", "client_id"]
    decided, left = [], candidates
    for k in range(rounds):
        criterion = F.col("criteria")[k]
        best = _dealt(left).groupBy(*group, _PIECE).agg(F.min(criterion).alias("best"), F.count("*").alias("n"))
        best = best.groupBy(*group).agg(F.min("best").alias("best"), F.sum("n").alias("n"))
        kept = written(_beside(_dealt(left), best, group).where(criterion == F.col("best")).drop("best"), f"round_{k}")
        decided.append(kept.where("n = 1").select(*group, *out))
        left = kept.where("n > 1").drop("n")
        if left.isEmpty():
            return reduce(DataFrame.unionByName, decided)
    tied = left.groupBy(*group).agg(F.min(F.struct(*out)).alias("v")).select(*group, "v.*")
    return reduce(DataFrame.unionByName, decided, tied)


def _records(clients: DataFrame) -> DataFrame:
    """The columns that the rules read: blank strings as null, ranks of source, recency and id (null last), and whether the record is stale."""
    kind = clients.schema["updated_at"].dataType
    trust = F.coalesce(*[F.when(F.col("source") == s, F.lit(k)) for k, s in enumerate(TRUST)], F.lit(len(TRUST))).cast("long")
    master = F.coalesce(F.col("master_id").cast("long"), F.col("client_id").cast("long"))
    balance = F.col("balance").cast("double")
    rows = clients.select(
        F.coalesce(master, F.lit(0)).alias("cluster"), master.isNull().alias("nameless"), F.col("client_id").cast("long"), _micros("updated_at", kind).alias("micros"), trust.alias("trust"),
        *[_text(c).alias(c) for c in ("name", "email", "segment", "city")], "nation_id", F.when((F.abs(balance) < float("inf")), balance).alias("balance"),
    )
    rows = written(rows.withColumn("rid", F.monotonically_increasing_id()), "clients")
    latest = _dealt(rows).groupBy(*_CLUSTER, _PIECE).agg(F.max("micros").alias("latest")).groupBy(*_CLUSTER).agg(F.max("latest").alias("latest"))
    rows = _beside(_dealt(rows), latest, list(_CLUSTER))
    stale = F.coalesce(F.col("latest") - F.col("micros") > STALE_HOURS * 3_600_000_000, F.lit(True))
    return rows.withColumn("stale", stale.cast("long")).withColumn("recent", F.coalesce(-F.col("micros"), F.lit(_LAST))).withColumn("order_id", F.coalesce("client_id", F.lit(_LAST))).drop("latest", "micros")


def _candidate(field: str, text: Column | None, criteria: list[Column], city: str | None = None, nation: str | None = None, balance: str | None = None) -> Column:
    value = F.struct(
        (text if text is not None else F.lit(None).cast("string")).alias("text"), (F.col(city) if city else F.lit(None).cast("string")).alias("city"),
        (F.col(nation) if nation else F.lit(None)).cast("int").alias("nation_id"), (F.col(balance) if balance else F.lit(None)).cast("double").alias("balance"),
    )
    return F.struct(F.lit(field).alias("field"), value.alias("value"), F.array(*[c.cast("long") for c in criteria]).alias("criteria"))


def golden_records(clients: DataFrame) -> DataFrame:
    """One record of each cluster of ``clients``: a record's cluster is its ``master_id``, if that is null its ``client_id``.

    Columns: ``cluster_id, n_records, n_stale, name, email, segment, city, nation_id, balance_cents, name_from, email_from, segment_from,
    balance_from, address_from``. Blank and empty strings count as null, other strings stay as they are; sources that are unknown or
    null are trusted least; balances that are no finite numbers count as null; null times and null ids come last, a record without a time
    is stale. Records without both ids are one cluster, whose id is null. Of records that repeat an id and are alike in all
    criteria the least value counts, each of them is a record. A field without a value is null, as is the id it comes from. An empty
    table gives no rows; other columns are ignored.
    """
    rows = written(_records(clients), "records")
    recent = [F.col("recent"), F.col("trust"), F.col("order_id")]
    trusted = [F.col("stale"), F.col("trust"), F.col("recent"), F.col("order_id")]
    filled = F.col("city").isNotNull().cast("long") + F.col("nation_id").isNotNull().cast("long")
    fields = F.array(
        _candidate("segment", F.col("segment"), recent),
        _candidate("email", F.col("email"), trusted),
        _candidate("name", F.col("name"), [-F.length("name"), *trusted]),
        _candidate("address", None, [-filled, *trusted], city="city", nation="nation_id"),
    )
    keys = [*_CLUSTER, "client_id", "rid"]
    wide = rows.select(*keys, F.explode(fields).alias("f")).select(*keys, "f.field", "f.value", F.col("f.criteria").alias("criteria"))
    # An array of criteria is as long as its field has, and ends with the id: what is beyond it decides nothing.
    wide = wide.where((F.col("field") == "address") | F.col("value.text").isNotNull()).withColumn("criteria", F.concat("criteria", F.array_repeat(F.lit(0).cast("long"), 5 - F.size("criteria"))))
    chosen = written(survivors(wide, 5), "chosen")
    segment = chosen.where("field = 'segment'").select(*_CLUSTER, F.col("value.text").alias("chosen"))
    every = rows.groupBy(*_CLUSTER).agg(F.count("*").alias("n_records"), F.sum("stale").alias("n_stale"))
    segment = every.select(*_CLUSTER).join(segment.hint("merge"), list(_CLUSTER), "left")
    other = F.coalesce((F.col("segment") != F.col("chosen")) | (F.col("segment").isNull() & F.col("chosen").isNotNull()), F.lit(False))
    funds = _beside(_dealt(rows.where("balance IS NOT NULL")), segment, list(_CLUSTER))
    funds = funds.select(*keys, _candidate("balance", None, [other, *recent], balance="balance").alias("f")).select(*keys, "f.field", "f.value", F.col("f.criteria").alias("criteria"))
    won = chosen.unionByName(survivors(funds, 4))
    pick = lambda field, column: F.max(F.when(F.col("field") == field, F.col(column)))  # noqa: E731 - a group has one row of each field
    fields = won.groupBy(*_CLUSTER).agg(
        *[pick(f, "value.text").alias(f) for f in ("name", "email", "segment")], pick("address", "value.city").alias("city"), pick("address", "value.nation_id").alias("nation_id"),
        F.floor(100 * pick("balance", "value.balance") + 0.5).cast("long").alias("balance_cents"), *[pick(f, "client_id").alias(f"{f}_from") for f in ("name", "email", "segment", "balance")],
        F.max(F.when((F.col("field") == "address") & (F.col("value.city").isNotNull() | F.col("value.nation_id").isNotNull()), F.col("client_id"))).alias("address_from"),
    )
    out = every.join(fields.hint("merge"), list(_CLUSTER))
    return out.select(F.when(~F.col("nameless"), F.col("cluster")).alias("cluster_id"), "n_records", "n_stale", *[c for c in fields.columns if c not in _CLUSTER])
