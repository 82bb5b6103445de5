"""Queries of the package against their SQL, and the pipeline against its parts."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from marginalia.llm import queries as Q
from tests.conftest import of_spark

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", Q.oracle_sql())
def test_query(spark, duck, name):
    assert of_spark(Q.queries()[name](spark, SF)) == duck(Q.oracle_sql()[name], SF)


def test_pipeline(spark):
    from tokenizers import Tokenizer

    from tests.llm.test_operators import plain_links, plain_spans

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "exact_dedup", "ngram_jaccard", "pii", "packing"]
    raw = {r.doc_id: r.text for r in docs.collect()}
    one = stages["quality_rules"](spark, docs, SF)
    verdict = {r.doc_id: r.kept for r in Q.queries()["op9_quality_rules"](spark, SF).collect()}
    kept = sorted(i for i in raw if verdict[i])
    assert one.columns == docs.columns and sorted(r.doc_id for r in one.collect()) == kept
    first = {}
    for i in kept:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", raw[i]), i)
    two = stages["exact_dedup"](spark, one, SF)
    left = sorted(first.values())
    assert two.columns == docs.columns and sorted(r.doc_id for r in two.collect()) == left
    root = plain_links([(i, raw[i]) for i in left])[2]
    three = stages["ngram_jaccard"](spark, two, SF)
    left = sorted(set(root.values()))
    assert three.columns == docs.columns and sorted(r.doc_id for r in three.collect()) == left
    four = stages["pii"](spark, three, SF)
    clean = {r.doc_id: r.text for r in four.collect()}
    assert four.columns == docs.columns and sorted(clean) == left
    assert all(clean[i] == raw[i] for i in left if not plain_spans(raw[i])) and not any(plain_spans(t) for t in clean.values())
    hf = Tokenizer.from_file(Q.vocabulary("word_bpe_49k.json"))
    ids = {i: np.array([*hf.encode(t, add_special_tokens=False).ids, 2], "<u4") for i, t in clean.items()}
    total = 0
    for r in corpus_pipeline.run(spark, SF).collect():
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        total += r.length
    assert total == sum(map(len, ids.values()))


def test_stages_on_odd_tables(spark):
    """Null ids, ids that repeat, null and empty texts, columns with the stages' own names, and no rows at all."""
    good = " ".join(f"w{k}" for k in range(60))
    rows = [(1, good, "en", "h", 1, "x"), (1, good, "en", "h", 1, "y"), (None, good + " tail", None, None, None, "z"), (None, None, "en", "h", 0, "q"), (2, "", "en", "h", 0, "q"), (3, good.replace("w3 ", "mail a.b@c.de "), "en", "h", 9, "r"), (3, "other " + " ".join(f"v{k}" for k in range(50)), "en", "h", 9, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    for some in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, some, SF)
            assert after.columns == docs.columns
            some = spark.createDataFrame(after.collect(), docs.schema)
        pieces = corpus_pipeline.STAGES[-1][1](spark, some, SF).collect()
        assert len({(r.doc_id, r.doc_tokens) for r in pieces}) == some.count()
    assert some.count() == 0 and pieces == []


def test_ids_of_prepared_texts_are_the_librarys():
    """Line feeds, marks, letters that compose, special tokens in other case: the library's ids, from few distinct segments."""
    import numpy as np
    import pyarrow as pa
    from tokenizers import Tokenizer

    from marginalia.llm import words
    from marginalia.llm.queries import vocabulary

    path = vocabulary("word_bpe_49k.json")
    bits = ["Hello", "É", "J̌", "J", "̌", "İ", "Σ", "<|ENDOFTEXT|>", "<|endoftext|>", "\n", " ", ".", "!?", "'S", "7", "\t", "中", "#*", "ÿ.", "×", "²."]
    rng = np.random.default_rng(8)
    texts = ["<|ENDOFTEXT|>", "A.\nb", None, *("".join(rng.choice(bits, rng.integers(0, 9))) for _ in range(3000))]
    ids, at = words.word_encoder(path).encode(pa.array(texts, pa.string()))
    library = Tokenizer.from_file(path)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert words._spaced(pa.array(["One. two\nTWO. ONE"])).to_pylist() == ["one . two two . one"]
