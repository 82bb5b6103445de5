from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from marginalia.streaming import visits as V

START = datetime(2024, 3, 1)
SCHEMA = "k string, ts timestamp, n long, kind string"


def plain(rows, gap):
    out = []
    for key in {r[0] for r in rows if r[0] is not None}:
        mine = sorted({(r[1], r[3] == "end", str(r[2])) for r in rows if r[0] == key and r[1] is not None})
        first = 0
        for k, (at, ends, _) in enumerate(mine):
            if ends or k + 1 == len(mine) or mine[k + 1][0] > at + timedelta(seconds=gap):
                out.append((key, mine[first][0], at, k + 1 - first, "end" if ends else "silence"))
                first = k + 1
    return sorted(out)


def test_visits_of_a_table_and_of_a_stream(spark, tmp_path):
    """Out of order within the delay, repeated, tied, null and late rows, visits that end, fall silent or stay open."""
    rng = random.Random(6)
    waves = []
    for w in range(4):
        base = START + timedelta(seconds=1500 * w)
        wave = [(rng.choice(["hot", "hot", "a", "b", None]), base + timedelta(seconds=rng.randrange(2000)), 100 * w + n, rng.choice(["view", "view", "view", "end"])) for n in range(40)]
        waves.append(wave + wave[:5] + [("a", None, 1, "view")])
    rows = [r for wave in waves for r in wave]
    df = spark.createDataFrame(rows, SCHEMA)
    closes = F.col("kind") == "end"
    got = sorted(tuple(r) for r in V.visits(df, "k", "ts", "n", closes, 120).collect())
    assert got == plain(rows, 120) and {r[4] for r in got} == {"end", "silence"}
    assert V.visits(df.limit(0), "k", "ts", "n", closes, 120).count() == 0

    late, flush = ("a", START - timedelta(days=1), 9000, "end"), ("z", START + timedelta(days=2), 9001, "view")
    for n, wave in enumerate([*waves, [flush], [late, waves[0][0], ("z", START + timedelta(days=2), 9002, "view")]]):
        spark.createDataFrame(wave, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        out = V.follow_visits(stream, "k", "ts", "n", closes, 120, "2000 seconds")
        out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert run() == plain(rows, 120)  # z's visit is open, the late rows are gone
    spark.createDataFrame([("y", START + timedelta(days=9), 1, "end")], SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/8")
    assert run() == sorted([*plain(rows, 120), ("z", flush[1], flush[1], 2, "silence")])
