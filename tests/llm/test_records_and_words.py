"""Spelling variants, golden records and near duplicates by coordinates against plain versions."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marginalia.llm import coordinate_join, golden, spelling
from marginalia.operators.graph import ends

LOWER = {c: c + 32 for c in range(65, 91)}


def plain_variants(pairs):
    counts = Counter()
    for i, t in pairs:
        for w in re.findall("[A-Za-z\u00C0-\u00FF]+", t or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    gaps, near = defaultdict(set), defaultdict(set)
    for w in n:
        for k in range(len(w)):
            gaps[w[:k] + "_" + w[k + 1 :]].add(w)
            if (short := w[:k] + w[k + 1 :]) in n:
                near[w].add(short)
                near[short].add(w)
    for same in gaps.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= 2 * n[w]:
                form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None)
    return out


def test_spelling_variants(spark):
    rng = random.Random(3)
    letters = "abeéÀ÷"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(60)] + ["abcdefg" * 30, "bcdefg" + "abcdefg" * 29, "lllll", "llllll", "lllllll"]
    words = []
    for w in base:
        words += [w] * rng.choice([1, 3, 8, 40])
        for _ in range(8):
            k = rng.randrange(len(w))
            words += [rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]])] * rng.choice([1, 3, 4, 6])
    words += ["chainaa"] * 5 + ["chainab"] * 30 + ["chainbb"] * 160
    rng.shuffle(words)
    texts = [rng.choice([" ", "1", "漢", "\n"]).join(words[k : k + 50]) for k in range(0, len(words), 50)] + [None, "", " ", "1234", "x" * 100_000, "GREEN Green", "Ünder ünder Ünder"]
    rows = [(k if k % 9 else None, t, t, 1) for k, t in enumerate(texts)] + [(3, texts[3], "again", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n int")
    want = plain_variants([(r[0], r[1]) for r in rows])
    got = [tuple(r) for r in spelling.spelling_variants(docs.repartition(3)).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(want) and {w: tuple(r) for w, *r in got} == want
    assert any(r[0] and r[1] != r[0] for r in want.values()) and max(r[3] for r in want.values()) > 3
    assert spelling.spelling_variants(docs.limit(0)).count() == 0


def test_words_are_counted_whatever_the_blocks(spark, monkeypatch):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("Alpha beta "), F.repeat(F.lit("gamma "), F.col("id").cast("int"))).alias("text"))
    once = sorted(map(tuple, spelling.word_counts(docs).collect()))
    monkeypatch.setattr(spelling, "TOGETHER", 10)
    monkeypatch.setattr(spelling, "_TABLED", 4)
    assert sorted(map(tuple, spelling.word_counts(docs).collect())) == once


def test_ends_of_chains(spark):
    links = [(k, k + 1) for k in range(100)] + [(500 + k, 50) for k in range(40)]
    got = {r.node: r.end for r in ends(spark.createDataFrame(links, "node long, to long")).collect()}
    assert got == {a: 100 for a, _ in links}
    assert ends(spark.createDataFrame([], "node long, to long")).count() == 0


def plain_golden(rows):
    def text(x):
        return x if x and re.search(r"[^\x20\x09-\x0D]", x) else None

    clusters = defaultdict(list)
    for r in rows:
        clusters[r["client_id"] if r["master_id"] is None else r["master_id"]].append(dict(r) | {c: text(r[c]) for c in ("name", "email", "segment", "city")})
    out = {}
    for c, members in clusters.items():
        times = [r["updated_at"] for r in members if r["updated_at"]]
        for r in members:
            r["stale"] = r["updated_at"] is None or max(times) - r["updated_at"] > timedelta(hours=1440)
            trust = golden.TRUST.index(r["source"]) if r["source"] in golden.TRUST else 4
            when = (r["updated_at"] is None, -(r["updated_at"] - datetime(2000, 1, 1)).total_seconds() if r["updated_at"] else 0)
            last = (r["client_id"] is None, r["client_id"] or 0)
            r["recent"], r["trusted"] = (when, trust, last), (r["stale"], trust, when, last)
            r["filled"] = (r["city"] is not None) + (r["nation_id"] is not None)

        def first(column, order, members=members):
            some = [r for r in members if r[column] is not None]
            best = min(some, key=lambda r: (order(r), r[column]), default=None)
            return (best[column], best["client_id"]) if best else (None, None)

        segment = first("segment", lambda r: r["recent"])
        email = first("email", lambda r: r["trusted"])
        name = first("name", lambda r: (-len(r["name"]), r["trusted"]))
        balance = first("balance", lambda r, s=segment[0]: (s is not None and r["segment"] != s, r["recent"]))
        home = min(members, key=lambda r: (-r["filled"], r["trusted"], r["city"] or "", r["nation_id"] or 0))
        cents = None if balance[0] is None else int((100 * balance[0] + 0.5) // 1)
        out[c] = (len(members), sum(r["stale"] for r in members), name[0], email[0], segment[0], home["city"], home["nation_id"], cents, name[1], email[1], segment[1], balance[1], home["client_id"] if home["filled"] else None)
    return out


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_golden_records(spark, zone):
    rng = random.Random(zone)
    start = datetime(2024, 3, 30)
    rows = []
    for k in range(400):
        at = rng.choice([None, start + timedelta(minutes=30 * rng.randrange(6000)), start, start + timedelta(hours=1440), start + timedelta(hours=1440, microseconds=1)])
        master = rng.choice([None, 1, 1, 1, *range(2, 60)])
        strings = [rng.choice([None, "", " \t", "a", "bb ", " bb", "çç", "😀😀"]) for _ in range(4)]
        rows.append((k if k % 50 else None, master, rng.choice(["crm", "web", "store", "partner", "fax", " ", None]), at, *strings, rng.choice([None, 1, 2]), rng.choice([None, 0.005, -3.335, 1e3, float("nan")]), "x", 7))
    rows += rows[5:25] + [(None, None, *r[2:]) for r in rows[30:36]]
    schema = "client_id long, master_id long, source string, updated_at timestamp_ntz, name string, email string, segment string, city string, nation_id int, balance double, cluster string, rid int"
    clients = spark.createDataFrame(rows, schema)
    names = clients.columns
    plain = [dict(zip(names, r, strict=True)) for r in rows]
    for r in plain:
        r["balance"] = None if r["balance"] != r["balance"] else r["balance"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = golden.golden_records(clients.repartition(5))
        columns = "n_records n_stale name email segment city nation_id balance_cents name_from email_from segment_from balance_from address_from".split()
        found = got.select("cluster_id", *columns).collect()
        assert len(found) == len({r[0] for r in found})
        want = plain_golden(plain)
        assert {r[0]: tuple(r[1:]) for r in found} == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert None in want
    assert golden.golden_records(clients.limit(0)).count() == 0


def plain_components(pairs):
    sets = []
    for i, t in pairs:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (t or "").translate(LOWER)) if x]
        sets.append((i, frozenset(tuple(w[k : k + 4]) for k in range(len(w) - 3)) if len(w) > 3 else frozenset([tuple(w)] if w else [])))
    order = sorted(range(len(sets)), key=lambda k: (sets[k][0] is None, sets[k][0] or 0))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, p in enumerate(order):
        for q in order[:x]:
            a, b = sets[p][1], sets[q][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                r, s = find(p), find(q)
                if r != s:
                    low, high = (r, s) if order.index(r) < order.index(s) else (s, r)
                    root[high] = low
    return [(i, len(s), sets[find(k)][0]) for k, (i, s) in enumerate(sets)]


@pytest.mark.parametrize("block", [256, 3])
def test_coordinate_join(spark, monkeypatch, block):
    """With small blocks, groups of unlinked texts that share passages are compared over many units."""
    monkeypatch.setattr(coordinate_join, "near_components", (lambda real: lambda docs: real(docs, block=block))(coordinate_join.near_components))
    rng = random.Random(8)
    vocab = [f"w{k}" for k in range(500)]
    some = lambda n: [rng.choice(vocab) for _ in range(n)]
    texts = [None, "", " \n", "One", "one", "one two three", "ONE two\tthree", "a b c d", "A B c d", "b c d e"]
    for _ in range(12):
        words = some(rng.randint(8, 120))
        for _ in range(rng.randint(1, 8)):
            w = words.copy()
            for _ in range(rng.randint(0, max(1, len(w) // 20))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            texts.append(" ".join(w))
            words = rng.choice([words, w])  # chains
    passage = some(60)
    texts += [" ".join(some(rng.randint(10, 40)) + passage + some(rng.randint(0, 20))) for _ in range(25)]
    texts += ["x " * 50_000, "x " * 50_000 + "y", texts[20], texts[20].upper()]
    rng.shuffle(texts)
    rows = [(k if k % 17 else None, t, "k", -1, 0) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, root int, id int").repartition(4)
    want = plain_components([(r[0], r[1]) for r in rows])
    got = coordinate_join.near_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert coordinate_join.near_duplicates(docs.limit(0)).count() == 0


def test_fewest_matches():
    assert [coordinate_join.fewest_matches(k) for k in (32, 64, 128)] == [15, 36, 82]
