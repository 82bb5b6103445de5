"""The corpus operators against plain versions, on small tables with nulls, empty and long texts, ties, repeats and odd columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginalia.llm import bpe, chat, exact_dedup, licenses, ngram_join, packing, pii, quality, suffix_dedup, token_files, words
from marginalia.llm.queries import vocabulary
from marginalia.llm.suffixes import Suffixes

WORD_BPE = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    vocab = ["the", "and", "of", "motion", "Été", "naïve", "l'eau", "don't", "x1", "42", "3.5", "###", "€", "日本", "😀"]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.randint(30, 90))) for _ in range(6)]
    out = [None, "", " ", "\n\t ", "word", "a b c d", "é" * 400, "ab" * 300, "a  b\n c", "long " * 6000]
    for b in base:
        out += [b, b, b.replace(" ", "\n", 3), b + " tail", b[: len(b) // 2] + " inserted words here " + b[len(b) // 2 :]]
    out += ["mail me at a.b@c.example.org, +49 170 1234567 or 10.0.0.1; a.b (at) c.example.org", "+1 (555) 010-9999 or 4111 1111 1111 1111 and 4111.1111.1111.1111"]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    """Ids in no order, one of them null, and columns named as the operators name their own."""
    ids = list(range(len(texts)))
    random.Random(5).shuffle(ids)
    rows = [(i, t, f"host{i % 3}" if i % 7 else None, "k", 1, True) for i, t in zip(ids, texts, strict=True)] + [(None, texts[12], None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, bucket string, rid int, kept boolean").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def held(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def test_quality_counts(docs, empty):
    got = defaultdict(list)
    for r in quality.quality(docs).collect():
        got[r.doc_id].append(r)
    for i, t in held(docs):
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = defaultdict(list)
        for k in range(len(ws) - 7):
            grams[tuple(ws[k : k + 8])].append(k)
        covered = {p for at in grams.values() if len(at) > 1 for k in at for p in range(k, k + 8)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        r = got[i][0]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r.kept and r.base_failed)
    assert quality.quality(empty).count() == 0
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for rs in got.values() for r in rs)


def test_bad_host_goes(spark):
    rows = [(k, "too short", "bad") for k in range(95)] + [(100 + k, " ".join(f"w{j}" for j in range(40)), "bad") for k in range(5)] + [(200 + k, " ".join(f"v{j}" for j in range(40)), "good") for k in range(100)]
    got = {r.doc_id: r.kept for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(got[k] for k in range(105) if k in got) and all(got[200 + k] for k in range(100))


def test_bad_host_among_many(spark):
    """Verdicts against a plain version on hosts of uneven sizes and rates, and the rows that the pipeline keeps."""
    good, bad = " ".join(f"w{j}" for j in range(30)), "too short"
    hosts = {f"h{k}": (10 * (k + 1), k % 4) for k in range(20)} | {"tiny": (1, 1), "awful": (60, 57), "half": (200, 108), None: (6, 6)}
    rows = [(h, bad if k < failed else f"{good} {h} {k}") for h, (n, failed) in hosts.items() for k in range(n)]
    df = spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id long, text string, source string")
    known = {h: v for h, v in hosts.items() if h}
    n, x = sum(a for a, _ in known.values()), sum(b for _, b in known.values())
    m = x / n
    spread = sum(b * b / a for a, b in known.values()) / n - m * m - m * (1 - m) * len(known) / n
    k = max(1, min(1e6, m * (1 - m) / spread - 1))
    rejected = set()
    for h, (a, b) in known.items():
        rate = (b + m * k) / (a + k)
        if rate - 1.645 * (rate * (1 - rate) / (a + k + 1)) ** 0.5 > 0.5:
            rejected.add(h)
    assert rejected == {"awful"}
    got = {r.doc_id: r.kept for r in quality.quality(df).collect()}
    assert got == {i: t != bad and h not in rejected for i, (h, t) in enumerate(rows)}
    assert sorted(r.doc_id for r in quality.keep_good(df).collect()) == sorted(i for i, kept in got.items() if kept)


def test_rows_that_repeat_an_id(spark):
    rows = [(1, "a b c"), (1, "a b c"), (1, "x y"), (2, "a  b c"), (None, "x y"), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_dedup.exact_dedup(df).collect()
    assert len(got) == 7 and sum(r.kept for r in got) == 3
    assert sorted((r.doc_id or 0, (r.text or "").replace("  ", " ")) for r in exact_dedup.keep_first(df).collect()) == [(0, ""), (1, "a b c"), (1, "x y")]


def test_exact_dedup(docs, empty):
    groups = defaultdict(list)
    for i, t in held(docs):
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t).encode()).hexdigest()].append(i)
    got = exact_dedup.exact_dedup(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        ids = [i for i in groups[r.text_sha256] if i is not None]
        assert (r.group_size, r.keep_id) == (len(groups[r.text_sha256]), min(ids) if ids else None) and r.kept == (r.doc_id == r.keep_id)
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert exact_dedup.keep_first(docs).count() == len(groups) and exact_dedup.keep_first(docs).columns == docs.columns


def test_perfect_hash():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 300, 5000):
        d = rng.integers(0, 256, (n, 32), dtype="u1")
        assert sorted(exact_dedup.PerfectHash.build(d).slots(d).tolist()) == list(range(n))


def plain_links(pairs):
    sets = {}
    for i, t in pairs:
        ws = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        n = min(5, len(ws))
        sets[i] = frozenset(tuple(ws[k : k + n]) for k in range(len(ws) - n + 1)) if ws else frozenset()
    linked = {i: {j for j in sets if j != i and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])} for i in sets}
    root = {}
    for i in sorted(sets):
        if i not in root:
            todo, root[i] = [i], i
            while todo:
                for j in linked[todo.pop()]:
                    if j not in root:
                        root[j] = i
                        todo.append(j)
    return sets, linked, root


@pytest.mark.parametrize("block", [1024, 2])
def test_near_duplicates(docs, empty, block, monkeypatch):
    some = docs.where("doc_id IS NOT NULL")
    sets, linked, root = plain_links(held(some))
    real = ngram_join.near_classes
    monkeypatch.setattr(ngram_join, "near_classes", lambda d: real(d, block=block))
    got = {r.doc_id: r for r in ngram_join.near_duplicates(some).collect()}
    for i, s in sets.items():
        assert (got[i].class_id, got[i].n_linked_docs, got[i].n_links) == (root[i], len(linked[i]), len({sets[j] for j in linked[i] if sets[j] != s}))
        assert got[i].kept == (root[i] == i)
    if block > 2:
        assert ngram_join.near_duplicates(empty).count() == 0
        assert ngram_join.keep_one(docs).count() == len(set(root.values()))


def test_near_duplicates_in_chains(spark):
    """Texts that slide on word by word: each links to its neighbours only, and the chain is one class. Ids repeat, some are null."""
    words_ = [f"w{k}" for k in range(400)]
    rows = [(1000 - k if k % 9 else None, " ".join(words_[k : k + 90])) for k in range(0, 300, 3)] + [(7, "alone among words of its own here")] * 2
    some = [(i, t) for i, t in rows if i is not None]
    sets, linked, root = plain_links(some)
    got = {r.doc_id: r for r in ngram_join.near_duplicates(spark.createDataFrame(some, "doc_id long, text string")).collect()}
    for i in sets:
        assert (got[i].class_id, got[i].n_links) == (root[i], len({sets[j] for j in linked[i] if sets[j] != sets[i]}))
    assert got[7].n_copies == 2
    kept = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(kept) == 2 and 7 in {r.doc_id for r in kept}


def test_bands():
    bands, rows = ngram_join.choose_bands(0.8, 0.999, 256)
    assert bands * rows <= 256 and 1 - (1 - 0.8**rows) ** bands >= 0.999


def test_byte_bpe(docs, empty):
    import public_tokenizers
    import tiktoken

    path = vocabulary("byte_bpe_50k.tiktoken")
    ranks = bpe.Ranks.load(path).ranks
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = defaultdict(list)
    for r in bpe.round_trip(docs, path, public_tokenizers.PATTERN).collect():
        got[r.doc_id].append((r.n_tokens, r.ids_sha256, r.decoded_sha256))
    for i, t in held(docs):
        ids = library.encode_ordinary(t)
        assert (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) in got[i]
    assert bpe.round_trip(empty, path, public_tokenizers.PATTERN).count() == 0


def test_encoders_on_odd_texts():
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    rng = random.Random(9)
    parts = ["a", "the", " ", "  ", "\n", "\t", "\x1c", "\x85", "\x00", "\x01", "　", "é", "é", "́", "İ", "ß", "한", "😀", "'s", "'re", "1", ".", "###", "<|endoftext|>", "Σ", "‍", "\xa0", "K", "x" * 70]
    some = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)] + ["a" * 3000, "=-" * 2000]
    path = vocabulary("byte_bpe_50k.tiktoken")
    ranks, encoder = bpe.tools(path, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.ranks, special_tokens={})
    for t, got in zip(some, encoder.encode_list(some), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == library.encode_ordinary(t)
        assert ranks.decode(np.frombuffer(got, "<u4")) == t.encode()
    hf = Tokenizer.from_file(vocabulary(WORD_BPE))
    for t, got in zip(some, words.word_encoder(vocabulary(WORD_BPE)).encode_list(some), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == hf.encode(t, add_special_tokens=False).ids


def library_ids(docs):
    from tokenizers import Tokenizer

    hf = Tokenizer.from_file(vocabulary(WORD_BPE))
    return [(i, np.array([*hf.encode(t, add_special_tokens=False).ids, 2], "<u4")) for i, t in held(docs)]


def test_token_files(docs, empty, spark, tmp_path):
    some = docs.where("doc_id IS NOT NULL")
    got = {r.doc_id: r for r in token_files.token_files(some, vocabulary(WORD_BPE)).collect()}
    start = 0
    for i, ids in sorted(library_ids(some), key=lambda x: x[0]):
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_files.token_files(docs, vocabulary(WORD_BPE)).where("doc_id IS NULL").first().start == 0
    assert token_files.token_files(empty, vocabulary(WORD_BPE)).count() == 0
    token_files.encode_files(some, vocabulary(WORD_BPE), f"{tmp_path}/ids", file_bytes=4000)
    assert sorted(r.doc_id for r in token_files.read_ids(spark, f"{tmp_path}/ids", 3, 5).collect()) == [3, 4, 5]
    counts = token_files.read_counts(spark, f"{tmp_path}/ids")
    assert "ids" not in counts._jdf.queryExecution().executedPlan().toString().partition("ReadSchema")[2] and counts.select("part").distinct().count() > 1


def test_token_files_have_dictionaries_deltas_and_page_indexes(docs, tmp_path):
    import pyarrow.parquet as pq

    token_files.encode_files(docs.where("doc_id IS NOT NULL"), vocabulary(WORD_BPE), f"{tmp_path}/ids")
    for file in tmp_path.glob("ids/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        assert meta.num_rows and meta.num_row_groups >= 1
        columns = {meta.row_group(0).column(k).path_in_schema.split(".")[0]: meta.row_group(0).column(k) for k in range(meta.num_columns)}
        assert any("DICTIONARY" in e for e in columns["ids"].encodings) and all("DICTIONARY" not in e for e in columns["doc_id"].encodings)
        for c in ("doc_id", "n_tokens", "row"):
            assert "DELTA_BINARY_PACKED" in columns[c].encodings, c
        assert columns["doc_id"].compression == "ZSTD" and columns["doc_id"].statistics.has_min_max and columns["doc_id"].has_column_index and columns["doc_id"].has_offset_index


def test_packing(docs, empty):
    want = defaultdict(list)
    for i, ids in library_ids(docs):
        want[i].append(ids)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs, vocabulary(WORD_BPE)).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, many in want.items():
        ids = many[0]
        assert sum(r.length for r in pieces[i]) == sum(map(len, many))
        for r in pieces[i]:
            assert (r.doc_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids[r.start : r.start + r.length].tobytes()))
    for spans in sequences.values():
        spans.sort()
        assert [a for a, _ in spans] == np.cumsum([0, *(n for _, n in spans[:-1])]).tolist() and sum(n for _, n in spans) <= 4096
    assert packing.pack(empty, vocabulary(WORD_BPE)).count() == 0


def test_plan_leaves_no_padding():
    rng = random.Random(1)
    for n, most in ((1, 5), (7, 30), (300, 4095), (2000, 900)):
        counts = defaultdict(int)
        for _ in range(n):
            counts[rng.randint(0, most)] += 1
        slots, sequences = packing.plan(dict(counts))
        used, cover = defaultdict(int), defaultdict(list)
        for s in slots:
            for k in range(s.low, s.high):
                used[s.sequence + (s.first + k - s.low) // s.copies] += s.length
                cover[s.rest, k].append((s.offset, s.length))
        assert len(used) == sequences and all(t <= 4096 and t & (t - 1) == 0 for t in used.values())
        for rest, c in counts.items():
            for k in range(c if rest else 0):
                spans = sorted(cover[rest, k])
                assert sum(x for _, x in spans) == rest and all(a + x == b for (a, x), (b, _) in zip(spans, spans[1:], strict=False))


def test_best_fill():
    assert packing.best_fill({3: 2, 5: 1}, 8) == {5: 1, 3: 1}
    assert packing.best_fill({4: 9}, 10) == {4: 2} and packing.best_fill({4: 1}, 3) == {}


def plain_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def test_base_spans():
    rng = random.Random(3)
    parts = ["a", "b.", "@", "@", "1", "2", "25", "300", "0", ".", "-", " ", "+", "(", ")", "é", "\n", "%", "x@y.z", "4111111111111111", "+49 170 12345", "0005", "😀", "٣"]
    for _ in range(5000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert pii.base_spans(t) == plain_spans(t)


def test_pii(docs, empty, texts):
    got = defaultdict(list)
    for r in pii.pii_report(docs).collect():
        got[r.doc_id].append(r)
    for i, t in held(docs):
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in plain_spans(t))
        r = got[i][0]
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and set(filter(None, base.split(","))) <= set(filter(None, r.spans.split(",")))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in plain_spans(t)) for k in pii.KINDS]
    assert pii.pii_report(empty).count() == 0
    masked = pii.mask(docs)
    assert masked.columns == docs.columns and masked.where("text IS NULL").count() == 1
    assert masked.where(F.col("text").rlike(r"@c\.|1234567|4111")).count() == 0


def test_field_on_held_out_texts():
    field, rng = pii.fitted(), np.random.default_rng(99)
    right = total = found = personal = 0
    for _ in range(100):
        text, mentions = pii.training_text(rng)
        nodes, y = pii._labelled(text, mentions)
        if not nodes:
            continue
        held = np.array([h for *_, h in nodes])
        score = field.scores(np.array([pii._features(text, a, b, f) for a, b, f, _ in nodes]), np.array([f for _, _, f, _ in nodes]), held)
        label = field.beliefs(score, pii.edges(text, nodes)).argmax(axis=1)
        right += (label == y)[held == 0].sum()
        total += (held == 0).sum()
        found += (label == y)[(held == 0) & (y > 0)].sum()
        personal += ((held == 0) & (y > 0)).sum()
    assert right / total > 0.95 and found / personal > 0.85


def test_messages_against_exact_sums():
    """Labels summed over: on chains messages are exact; on loops they are near where edges are weak, and with the fitted edges, which make
    them too sure, they agree on the best label."""
    import itertools

    rng, fitted = np.random.default_rng(4), pii.fitted()
    weak = pii.Field(fitted.node, np.full(len(pii.EDGES), 0.7))
    for field, loop in [(fitted, False), (weak, True), (fitted, True)] * 15:
        n = int(rng.integers(3, 5))
        links = [(i, i + 1, pii._EQUAL) for i in range(n - 1)] + [(0, n - 1, pii._EQUAL)] * loop
        score = rng.normal(0, 1.5, (n, 5))
        exact = np.zeros((n, 5))
        for y in itertools.product(range(5), repeat=n):
            w = np.exp(sum(score[i, k] for i, k in enumerate(y)) + sum(field.edge[e] for i, j, e in links if y[i] == y[j]))
            for i, k in enumerate(y):
                exact[i, k] += w
        exact /= exact.sum(axis=1, keepdims=True)
        got = field.beliefs(score, links)
        if field is weak or not loop:
            assert np.abs(got - exact).max() < (0.1 if loop else 0.001)
        assert all(g.argmax() == e.argmax() for g, e in zip(got, exact, strict=True) if np.sort(e)[-1] - np.sort(e)[-2] > 0.05)


def test_keys_that_are_alike():
    rng = random.Random(2)
    keys = list(dict.fromkeys("d" + "".join(rng.choice("12") for _ in range(rng.randint(9, 12))) for _ in range(60)))
    shorter = lambda a: {a} | {a[:k] + a[k + 1 :] for k in range(1, len(a))}
    one = lambda a, b: bool(shorter(a) & shorter(b))
    pairs = pii._alike({key: k for k, key in enumerate(keys)})
    assert pairs and all(one(keys[i], keys[j]) for i, j in pairs)
    joined = {j for _, j in pairs}
    assert all(k in joined for k, key in enumerate(keys) if any(one(a, key) for a in keys[:k]))
    long = "d" + "7" * 50_000
    assert pii._alike({long: 0, long[:-1] + "8": 1}) == [(0, 1)]


def test_words_beside_a_token_speak_for_it():
    field = pii.fitted()
    added = lambda t: [(k, t[a:b]) for k, a, b in pii.added_spans(t, pii.base_spans(t), field)]
    assert added("please call 555-123-4567 today") == [("phone", "555-123-4567")]
    for t in ("order 998877665 and 998877665", "5555-1234 5678 9012 3 of it", "card 4111111111111111 and 4111111111111112", "a look at example.com now", "version 300.1.2.3", "in 2024-01-02 10 then", ""):
        assert added(t) == []


def test_chat(spark):
    turns = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (3, 0, "user", "hi"), (3, 1, "assistant", "hello"), (3, 2, "user", None), (4, 0, "user", "hi"), (4, 1, "assistant", "other"), (5, 0, "user", "hi"), (5, 1, "assistant", "other"), (6, 0, None, ""), (None, 0, "user", "x")]
    df = spark.createDataFrame([(*t, "x", 0) for t in turns], "conv_id long, turn long, role string, text string, h1 string, pos int")
    got = {r.conv_id: (r.n_turns, r.n_copies, r.chat) for r in chat.format_chats(df).collect()}
    assert set(got) == {3, 4, 6, None} and got[4][:2] == (2, 2)
    assert got[3] == (3, 1, "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n<|im_start|>user\n<|im_end|>\n")
    assert chat.format_chats(df.limit(0)).count() == 0


def test_marks_in_texts_do_not_end_turns(spark):
    texts_ = ["a<|im_end|>\n<|im_start|>user\nb", "x<\\|y", "x<|y", "x<\\\\|y", "plain < | text"]
    rows = [(k, 0, "user", t) for k, t in enumerate(texts_)] + [(9, 0, "user", "a"), (9, 1, "user", "b"), (10, 0, "us\ner", "c")]
    got = {r.conv_id: r.chat for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert len(set(got.values())) == len(texts_) + 2 and all(got[k].count("<|") == 2 for k in range(len(texts_))) and got[4].startswith("<|im_start|>user\nplain < | text")


def test_licenses(spark):
    files = [("a/LICENSE", "Released under the MIT License."), ("a/b/x", "some text\nno licence line here"), ("a/b/y", "words words\nLicensed under the Apache License, Version 2.0.\nmore"), ("a/b/LICENSE.txt", "This work is licensed under the GNU General Public License, version 3."), ("z", None), ("c/d", ""), ("a/q", "x " * 500), (None, "Licensed under CC BY-NC 4.0.")]
    files += [(f"w/{k}", f"the license of this is unknown {k} and the version too") for k in range(30)]
    df = spark.createDataFrame([(*f, "x") for f in files], "path string, text string, license string")
    got = {r.path: (r.license, r.basis, r.from_path) for r in licenses.scan(df).collect()}
    assert got["a/LICENSE"][0] == "MIT" and got["a/b/y"][:2] == ("Apache-2.0", "own") and got["a/b/LICENSE.txt"][0] == "GPL-3.0"
    assert got["a/b/x"] == ("GPL-3.0", "inherited", "a/b/LICENSE.txt") and got["a/q"] == ("MIT", "inherited", "a/LICENSE")
    assert got["z"] == got["c/d"] == (None, None, None) and got[None][0] == "CC-BY-NC-4.0" and got["w/3"][0] is None
    assert len(got) == len(files) and licenses.scan(df.limit(0)).count() == 0


def test_licences_weigh_all_terms_by_their_frequency(spark):
    files = [(f"w/{k}", f"see here for more {k}") for k in range(400)] + [("a/x", "See here for more: Released under the MIT License.")]
    got = {r.path: r.license for r in licenses.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert got.pop("a/x") == "MIT" and set(got.values()) == {None}


def test_licences_across_lines_and_inside_long_lines(spark):
    other = lambda a, b: " ".join(f"u{k}" for k in range(a, b))
    apache = "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."
    files = [("a/x", f"{other(0, 90)} Released under the MIT License. {other(90, 200)}"), ("b/x", f"{other(0, 9)} Released under\nthe MIT License. {other(9, 20)}"), ("c/x", f"{other(0, 12)} {apache} {other(12, 60)}"), ("d/x", other(0, 50)), ("e/x", "")]
    files += [(f"f/{at}", f"{other(0, at)} {apache.replace(' ', chr(10))} {other(at, 60)}") for at in (0, 7, 60)]
    got = {r.path: r.license for r in licenses.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert got == {"a/x": "MIT", "b/x": "MIT", "c/x": "Apache-2.0", "d/x": None, "e/x": None} | {f"f/{at}": "Apache-2.0" for at in (0, 7, 60)}


def plain_licences(files, threshold=0.8):
    """All windows of all lengths of templates, each weighed in full."""
    import math

    every = [(p, licenses._terms(t or "")) for p, t in files]
    df = defaultdict(int)
    for _, w in every:
        for t in set(w):
            df[t] += 1
    idf = lambda t: math.log((1 + len(every)) / (1 + df.get(t, 0))) + 1
    vec = lambda w: {t: w.count(t) * idf(t) for t in set(w)}
    dot = lambda a, b: sum(x * b.get(t, 0) for t, x in a.items())
    out = {}
    for path, w in every:
        best = None
        for x in licenses.TEMPLATES:
            n, v = len(x.terms), vec(list(x.terms))
            if dot(v, {t: v[t] for t in set(w) & set(v)}) < 0.64 * dot(v, v):
                continue
            for start in [*range(max(1, len(w) - n + 1)), -1]:
                window = w if start < 0 else w[start : start + n]
                u = vec(window)
                c = dot(u, v) / math.sqrt(dot(u, u) * dot(v, v)) if u else 0
                low = max(0, start - 3)
                negated = sum(t in licenses.NEGATIONS for t in (w if start < 0 else w[low : start + n])) > sum(t in licenses.NEGATIONS for t in x.terms)
                if c >= threshold and not (x.kind == "statement" and negated) and not (x.kind == "tag" and not set(v) <= set(window)):
                    best = max(best or (-1e9,), (round(n * (9 * c - 8), 6), round(c, 9), x.license))
        out[path] = best[2] if best else None
    return out


def real_licences():
    from pathlib import Path

    folder = Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0", "BSD": "BSD-3-Clause"}
    return [(f"real/{name}/text", (folder / name).read_text(), want) for name, want in names.items() if (folder / name).exists()]


def test_licences_against_all_windows(spark):
    rng = random.Random(8)
    say = lambda n: " ".join(rng.choice(["code", "of", "the", "and", "this", "file", "is", "we", "use", "to", "software", "license", "version"]) for _ in range(n))
    block = lambda t, mark: "\n".join(f"{mark} {' '.join(t.split()[k : k + 9])}" for k in range(0, len(t.split()), 9))
    cases = [(f"own/{k}/x", f"{say(rng.randint(0, 30))} {text if k % 2 else block(text, rng.choice(['//', '#', ' *', '--', ';']))} {say(rng.randint(0, 30))}", name) for k, (name, text) in enumerate([*licenses.STATEMENTS, *licenses.NOTICES, *licenses.TITLES])]
    cases += [(f"tag/{k}/x", f"// SPDX-License-Identifier: {tag}\n{say(20)}", name) for k, (tag, name) in enumerate(licenses.TAGS.items())]
    cases += [("no/1", "This is not released under the MIT License.", None), ("no/2", "SPDX-License-Identifier: LicenseRef-own " + say(9), None), ("no/3", "It was never licensed under the Apache License, Version 2.0.", None), ("no/4", say(200), None)]
    cases += real_licences()
    files = [(p, t) for p, t, _ in cases] + [(f"w/{k}", say(25)) for k in range(300)]
    got = {r.path: r.license for r in licenses.scan(spark.createDataFrame(files, "path string, text string")).where("basis = 'own'").collect()}
    assert {p: got.get(p) for p, _, _ in cases} == {p: want for p, _, want in cases}
    few = [(p, t) for p, t in files if len(t) < 3000 or p.endswith("CC0-1.0/text")]
    want = plain_licences(files)
    assert {p: got.get(p) for p, _ in few} == {p: want[p] for p, _ in few}


def test_licence_texts_license_their_directory(spark):
    texts_ = real_licences()
    if not texts_:
        pytest.skip("no licence texts here")
    files = [(p, t) for p, t, _ in texts_] + [(p.rpartition("/")[0] + "/src/deep/a.c", "int main") for p, _, _ in texts_] + [("other/b.c", "int main")]
    files += [(f"more/{k}", f"see the software of version {k} and the license of the public file") for k in range(60)]
    got = {r.path: (r.license, r.basis) for r in licenses.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    for p, _, want in texts_:
        if want != "BSD-3-Clause":  # its file has neither a title nor a name
            assert got[p.rpartition("/")[0] + "/src/deep/a.c"] == (want, "inherited")
    assert got["other/b.c"] == (None, None)


def plain_removed(pairs, length=100):
    seen, out = set(), {}
    for i, t in sorted(pairs, key=lambda p: p[0]):
        s = t.encode()
        gone = bytearray(len(s))
        for p in range(len(s) - length + 1):
            w = s[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(w)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i] = (len(s), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(s, gone, strict=True) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("frequent", [1000, 3])
def test_suffix_dedup(docs, empty, frequent, monkeypatch):
    """With few strings counting as frequent, equal segments meet in a tree of several levels."""
    monkeypatch.setattr(suffix_dedup, "FREQUENT", frequent)
    if frequent == 3:
        monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 2000)
        monkeypatch.setattr(suffix_dedup, "FAN", 3)
        monkeypatch.setattr(suffix_dedup, "parts_for", lambda rows, per, least=1: 9 if per == 2000 else 4)
    some = docs.where("doc_id IS NOT NULL")
    want = plain_removed(held(some))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(some).collect()}
    assert got == want
    if frequent == 3:
        assert suffix_dedup.suffix_dedup(empty).count() == 0
        null_row = suffix_dedup.suffix_dedup(docs).where("doc_id IS NULL").first()
        assert null_row.n_removed == null_row.n_bytes


def test_suffix_order():
    rng = random.Random(5)
    for _ in range(500):
        depth = rng.choice([3, 8, 10, 20])
        strings = [bytes(rng.choice([0, 97, 98, 255]) for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(0, 6))]
        s, ends = np.frombuffer(b"".join(strings), "u1"), np.cumsum([len(x) for x in strings]).astype("i8")
        wanted, at = np.zeros(len(s), bool), 0
        for x in strings:
            wanted[at : at + max(0, len(x) - depth + 1)] = True
            at += len(x)
        suffixes = Suffixes(s, ends, depth)
        order = suffixes.order(wanted)
        found = [bytes(s[k : k + depth]) for k in order]
        assert sorted(order.tolist()) == np.flatnonzero(wanted).tolist() and found == sorted(found)
        same = [0] + [next((k for k in range(depth) if a[k] != b[k]), depth) for a, b in zip(found, found[1:], strict=False)]
        assert suffixes.common(order).tolist() == same[: len(found)]


@pytest.mark.parametrize("kind, plain, loose", [
    ("email", "joe.x1@mail5.example.com", "joe.x1 (at) mail5.example.com"), ("email", "joe.x1@mail5.example.com", "joe.x1 at mail5 dot example dot com"), ("card", "4111 1111 1111 1111", "4111.1111.1111.1111"),
    ("phone", "+44 20 7946 0958", "44/20/7946/0958"), ("ip", "10.20.30.40", "10[.]20[.]30[.]40"), ("ip", "10.20.30.40", "10 . 20 . 30 . 40"),
])
def test_all_repeats_hear_of_their_base_span(kind, plain, loose):
    field = pii.fitted()
    for n in (*range(1, 11), 20, 35, 50):
        text = f"see {plain} now" + f" or {loose} then" * n
        base = pii.base_spans(text)
        assert len(base) == 1
        added = pii.added_spans(text, base, field)
        assert [k for k, _, _ in added] == [kind] * n and loose not in pii.masked_text(text, base + added)


def test_texts_meet_their_losers_once_and_alike_at_all_sizes(spark):
    """Few losers are not sent to all tasks, and texts are read and dealt once, also for rows that repeat an id and a text."""
    rows = [(1, "a b"), (1, "a b"), (2, "a  b"), (3, "c"), (None, "c"), (None, None), (None, ""), (4, "d")]
    kept = exact_dedup.keep_first(spark.createDataFrame(rows, "doc_id long, text string"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan and "Union" not in plan
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, ""), (1, "a b"), (3, "c"), (4, "d")]
