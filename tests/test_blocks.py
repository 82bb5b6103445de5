from __future__ import annotations

import random
import shutil

from pyspark.sql import functions as F

from marginalia.operators import blocks as B
from marginalia.plans import texts as queries
from tests.conftest import of_spark


def test_sentences_make_up_the_text():
    rng = random.Random(3)
    parts = ["Mr. ", "One. ", "two. three", "。", "！", " ", "\n", "a" * 30, "Dr. Who. ", "3.14 ", "End? ", "「x」。", "　"]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 30)))
        assert "".join(B.sentences(text)) == text


def test_sentence_rules():
    assert B.sentences("Mr. Smith went far away from home. Then he came back again.") == ["Mr. Smith went far away from home.", " Then he came back again."]
    assert B.sentences("The value 3.14 is near the truth of it. and so on") == ["The value 3.14 is near the truth of it. and so on"]
    assert B.sentences("Ja! This sentence is a long one for sure.") == ["Ja! This sentence is a long one for sure."]
    assert [len(x) for x in B.sentences("x" * 2000)] == [800, 800, 400]


def test_source_blocks(spark):
    long = " ".join(f"Sentence number {k} of a long paragraph ends here." for k in range(40))
    texts = [(1, f"First.\n\n***\n\n  {long}  \n　\nLast one"), (2, ""), (3, "   "), (4, "no blank line")]
    units = spark.createDataFrame(texts, "unit_id long, text string")
    b = B.source_blocks(units, "unit_id")
    got = {k: [] for k, _ in texts}
    for r in b.orderBy("unit_id", "block_index").collect():
        got[r.unit_id].append(r)
    for k, text in texts:
        assert "".join(r.text for r in got[k]) == text
        assert all(text[r.start : r.end] == r.text for r in got[k])
    assert [r.is_rule for r in got[1]][:2] == [False, True]
    assert all(len(r.text.strip()) <= 800 for r in got[1])
    assert B.contiguity_issues(b, "unit_id").count() == 0
    broken = b.withColumn("end", F.when(F.col("block_index") == 0, F.col("end") + 1).otherwise(F.col("end")))
    assert B.contiguity_issues(broken, "unit_id").count() >= 2


def test_paragraphs_are_cut_alike_both_ways(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice(["a", "b c", "\n", "\n", " ", "\t", "　", "\r"]) for _ in range(rng.randint(0, 25))) for _ in range(400)] + ["", "\n\n", "a\n\n\n", "x" + "\n" * 3000 + "y"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    slow = F.regexp_extract_all("t", F.lit(r"(?s)(?U)\A\n\s*\n|.+?(?:\n\s*\n|\z)"), 0)
    for r in df.select("k", B.paragraphs(F.col("t")).alias("fast"), slow.alias("slow")).collect():
        assert r.fast == r.slow and "".join(r.fast) == texts[r.k]
    odd = df.select(B.paragraphs(F.concat("t", F.lit("\ue000z"))).alias("p"), "k")
    assert all("".join(r.p) == texts[r.k] + "\ue000z" for r in odd.collect())


def test_units_that_share_a_key_and_units_without_text(spark):
    many = "".join(f"line {k}\n" for k in range(3 * B._STEP + 7))
    units = spark.createDataFrame([(1, many, "x"), (1, "other\n\ntext", "y"), (None, "no key", "z"), (2, None, "n"), (3, "", "e")], "unit_id long, text string, start string")
    b = B.placed(units, B.lines(F.col("text")), "unit_id").collect()
    of = [r for r in b if r.unit_id == 1 and r.text.startswith("line")]
    assert [r.block_index for r in of] == list(range(3 * B._STEP + 7))
    assert all(many[r.start : r.end] == r.text for r in of)
    assert sorted(r.text for r in b if r.unit_id == 1 and not r.text.startswith("line")) == ["\n", "other\n", "text"]
    assert {r.unit_id for r in b} == {1, None}
    assert {r.unit_id for r in B.source_blocks(units, "unit_id").collect()} == {1, None}
    assert B.source_blocks(units.limit(0), "unit_id").count() == 0


def test_source_blocks_like_sentences_and_without_a_shuffle(spark, duck, tmp_path):
    rng = random.Random(9)
    parts = ["Mr. Who went ", "One sentence of a paragraph ends here. ", "two. three ", "好的。", "Why! ", "\n", "word " * 40, "Dr.St. Paul. ", "3.14 ", "End? ", "“Said.” He ", "　", "x" * 900]
    paragraphs = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts = [(k, "\n\n".join(rng.choice(paragraphs) for _ in range(rng.randint(1, 5)))) for k in range(60)] + [(60, None), (61, "")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    b = B.source_blocks(df, "doc_id")
    assert "Exchange" not in b._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in b.collect():
        got.setdefault(r.doc_id, []).append(r)
    for k, text in texts[:60]:
        assert "".join(r.text for r in got[k]) == text and all(text[r.start : r.end] == r.text for r in got[k])
        whole = df.where(F.col("doc_id") == k).select(B.paragraphs(F.col("text"))).first()[0]
        assert [r.text for r in got[k]] == [x for p in whole for x in (B.sentences(p) if len(p.strip()) > 800 else [p])]
    df.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    file = next(p for p in (tmp_path / "documents.parquet").iterdir() if p.suffix == ".parquet")
    (tmp_path / "sql").mkdir()
    shutil.copy(file, tmp_path / "sql" / "documents.parquet")
    for name in ("source_blocks", "source_block_issues"):
        assert of_spark(queries.catalog.queries[name](spark, str(tmp_path))) == duck(queries.catalog.sql[name], str(tmp_path / "sql"))


def test_sentences_are_packed_while_a_batch_is_cut(spark, monkeypatch):
    """Only so many characters of a batch are Python strings at once; nulls and empty lists stay what they are."""
    import pyarrow as pa

    long = " ".join(f"Sentence number {k} of a long paragraph ends here." for k in range(40))
    units = [[long, None, "x" * 2000], None, [], [None, long + " Ä。ö"]]
    want = [None if u is None else [None if c is None else B.sentences(c) for c in u] for u in units]
    packed, array = [], pa.array
    monkeypatch.setattr(B, "_PACKED", 100)
    monkeypatch.setattr(B.pa, "array", lambda x, *of: (packed.append(len(x)) if of == (pa.string(),) else None, array(x, *of))[1])
    got = B._cut(array(units, pa.list_(pa.string())))
    monkeypatch.undo()
    assert got.to_pylist() == want and sum(packed) == sum(len(c) for u in want if u for c in u if c) and len([n for n in packed if n]) == 3
    plan = B.source_blocks(spark.createDataFrame([(1, long)], "unit_id long, text string"), "unit_id")._jdf.queryExecution().toString()
    assert "_sentences" in plan and "ArrowEvalPython" in plan
