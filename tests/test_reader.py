from __future__ import annotations

import zipfile

import pytest
from pyspark.sql import functions as F

from marginalia.sources import reader
from marginalia.sources.store import append_run, run_hash, runs


def test_text_units(spark, tmp_path):
    (tmp_path / "b.txt").write_bytes("Chapter 1\nabc é\nChapter 2\nend".encode())
    got = [tuple(r) for r in reader.units_of(spark, str(tmp_path / "b.txt")).orderBy("unit_id").select("label", "text").collect()]
    assert got == [("Chapter 1", "Chapter 1\nabc é\n"), ("Chapter 2", "Chapter 2\nend")]


def test_text_without_headings(spark, tmp_path):
    (tmp_path / "c.txt").write_text("x" * 150_000)
    got = reader.units_of(spark, str(tmp_path / "c.txt")).select(F.length("text").alias("n")).collect()
    assert sorted(r.n for r in got) == [150_000 - 2 * 65536, 65536, 65536]


def _epub(path, nav: str, spine=("a", "b")):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("META-INF/container.xml", '<container xmlns="urn:x"><rootfiles><rootfile full-path="o/c.opf"/></rootfiles></container>')
        z.writestr("o/c.opf", '<package xmlns="p" xmlns:dc="d"><metadata><dc:title>T</dc:title></metadata><manifest><item id="a" href="a.xhtml" media-type="application/xhtml+xml"/><item id="b" href="b.xhtml" media-type="application/xhtml+xml"/>' + nav + "</manifest><spine>" + "".join(f'<itemref idref="{x}"/>' for x in spine) + "</spine></package>")
        z.writestr("o/a.xhtml", '<html><body><h1 id="x">One</h1><p>first</p><h2 id="y">Sub</h2><p>second</p></body></html>')
        z.writestr("o/b.xhtml", "<html><body><h1>Two</h1><p>third &amp; last</p><script>no()</script></body></html>")
        z.writestr("o/n.xhtml", '<html xmlns:e="u"><body><nav e:type="toc"><ol><li><a href="a.xhtml#x">One</a><ol><li><a href="a.xhtml#y">Sub</a></li></ol></li><li><a href="b.xhtml">Two</a></li></ol></nav></body></html>')
        z.writestr("o/t.ncx", '<ncx xmlns="n"><navMap><navPoint><navLabel><text>One</text></navLabel><content src="a.xhtml"/></navPoint><navPoint><navLabel><text>Two</text></navLabel><content src="a.xhtml#gone"/></navPoint></navMap></ncx>')


def test_epub(spark, tmp_path):
    _epub(tmp_path / "n.epub", '<item id="n" href="n.xhtml" media-type="application/xhtml+xml" properties="nav"/>')
    got = reader.epub_units(spark, str(tmp_path / "n.epub")).orderBy("ord").collect()
    assert [(r.label, r.level, r.parent_id, r.text) for r in got] == [("One", 1, "book", "One\nfirst\nSub\nsecond"), ("Sub", 2, "unit-0001", "Sub\nsecond"), ("Two", 1, "book", "Two\nthird & last")]
    _epub(tmp_path / "t.epub", '<item id="t" href="t.ncx" media-type="application/x-dtbncx+xml"/>')
    got = reader.epub_units(spark, str(tmp_path / "t.epub")).orderBy("ord").collect()
    assert [(r.label, r.spine_index) for r in got] == [("One", 0), ("Two", 1)]  # the second target is wrong and found by its title
    _epub(tmp_path / "s.epub", "")
    assert [r.label for r in reader.epub_units(spark, str(tmp_path / "s.epub")).orderBy("ord").collect()] == ["One", "Two"]


def test_encoding():
    assert reader.sniff_encoding(b"\xef\xbb\xbfabc") == ("utf-8", b"\xef\xbb\xbf")
    assert reader.sniff_encoding("abc".encode("utf-16"))[0] == "utf-16-le" and reader.sniff_encoding("plain text here".encode("utf-16-be"))[0] == "utf-16-be"
    assert reader.sniff_encoding("déjà vu".encode("latin-1"))[0] == "cp1252" and reader.sniff_encoding("浮生六记闲情记趣".encode("gbk") * 5)[0].startswith("gb")
    assert reader.sniff_encoding("é".encode() * 9 + b"\xc3") == ("utf-8", b"") and reader.sniff_encoding(b"") == ("utf-8", b"")
    assert reader.html_encoding(b'<?xml version="1.0" encoding="gb2312"?>') == "gb2312" and reader.html_encoding(b"<meta charset=nonsense>") == "utf-8"
    assert reader.decoded_page('<meta charset="gbk"><p>记</p>'.encode("gbk")).endswith("<p>记</p>")


def test_books_in_other_encodings(spark, tmp_path):
    text = "Chapter 1\nabc é – ü\nChapter 2\nend"
    for name, encoding, body in (("l", "cp1252", text), ("u", "utf-16", text), ("b", "utf-16-be", text), ("g", "gbk", "第一章 闲情\n余忆童稚时，能张目对日。\n第二章 坎坷\n人生坎坷，何为乎来哉？")):
        (tmp_path / f"{name}.txt").write_bytes(body.encode(encoding))
        got = [r.text for r in reader.units_of(spark, str(tmp_path / f"{name}.txt")).orderBy("unit_id").collect()]
        assert "".join(got) == body and len(got) == 2, name
    (tmp_path / "bad.txt").write_bytes(b"Chapter 1\nabc \xff\xfe\x81 end" + "é".encode() * 3)
    assert reader.units_of(spark, str(tmp_path / "bad.txt")).count() == 1


def test_epub_metadata_and_content_units(spark, tmp_path):
    _epub(tmp_path / "m.epub", "")
    assert tuple(reader.epub_metadata(spark, str(tmp_path / "m.epub")).first())[1:] == ("T", "", "", 2)
    units = spark.createDataFrame([("book", None, "book"), ("p", "book", "part"), ("c", "p", "chapter"), ("d", "book", "section")], "unit_id string, parent_id string, kind string")
    assert sorted(r.unit_id for r in reader.content_units(units).collect()) == ["c", "d"]
    assert [r.unit_id for r in reader.content_units(units.where("unit_id = 'book'")).collect()] == []


def test_source_index(spark, tmp_path):
    from marginalia.sources import index

    units = spark.createDataFrame([("unit-0001", "One.\n\nTwo."), ("unit-0002", "Three.")], "unit_id string, text string")
    (tmp_path / "b.txt").write_bytes(b"x")
    digest = index.file_digests(spark, str(tmp_path / "b.txt")).first().digest
    built = index.build(units, "b", "b.txt", digest, "txt")
    assert built["meta"]["source_index_id"] == index.index_id("b", digest, "txt") != index.index_id("b", digest, "epub")
    got = index.load(spark, index.save(spark, built, str(tmp_path / "index")))
    assert got["meta"] == built["meta"] and got["meta"]["block_count"] == 3 and got["meta"]["total_chars"] == 16
    rows = got["blocks"].orderBy("block_id").collect()
    assert [(r.block_id, r.unit_id, r.book_start, r.book_end) for r in rows] == [("block-000001", "unit-0001", 0, 6), ("block-000002", "unit-0001", 6, 10), ("block-000003", "unit-0002", 10, 16)]
    assert [r.text for r in index.blocks_of_unit(got["blocks"], "unit-0001", 5, 7).collect()] == ["One.\n\n", "Two."] and index.blocks_of_unit(got["blocks"], "zz").count() == 0
    assert "text" not in index.block_metadata(got["blocks"]).columns and "book_start" in index.package_blocks(got["blocks"]).first().provenance
    assert '"unit-0002"' in index.to_json(got, units)
    spark.createDataFrame([("v0",)], "schema_version string").write.mode("overwrite").json(f"{tmp_path}/index/b/meta")
    with pytest.raises(ValueError, match="schema"):
        index.load(spark, f"{tmp_path}/index/b")


def test_runs(spark, tmp_path):
    assert run_hash(a=1, b="x") == run_hash(b="x", a=1) and run_hash(a=2).startswith("run-")
    append_run(spark, str(tmp_path / "runs"), unit="u1")
    append_run(spark, str(tmp_path / "runs"), unit="u2")
    assert [r.run for r in runs(spark, str(tmp_path / "runs")).collect()] == ['{"unit": "u2"}', '{"unit": "u1"}']


def test_lines_of_files_that_are_cut(spark, tmp_path):
    """Files of several pieces, marks, encodings, carriage returns, missing and repeated last ends, empty files: as if read whole."""
    from marginalia.sources import reader

    body = "".join(f"Zeile {k} é\r\n" if k % 3 else f"line {k} ü\n" for k in range(400))
    files = {
        "a b.txt": body.encode(), "bom.txt": b"\xef\xbb\xbf" + body.encode(), "bom only.txt": b"\xef\xbb\xbf", "west.txt": body.encode("cp1252"), "none.txt": b"", "end.txt": b"\n", "ends.txt": b"a\n\n", "one.txt": b"no end",
        "han.txt": ("春眠不覺曉處處聞啼鳥\n" * 300).encode("gb18030"), "wide.txt": b"\xff\xfe" + body.encode("utf-16-le"), "four.txt": b"\xff\xfe\x00\x00" + body.encode("utf-32-le"), "bad.txt": b"ok\n\xff\xfe broken \x80\nx",
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    want = sorted((name, k, at, text) for name, data in files.items() if data for k, (at, text) in enumerate(reader._lines(data), 1))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = sorted((r.path.rpartition("/")[2], r.line, r.start_byte, r.text) for r in reader.text_lines(spark, f"{tmp_path}/*.txt").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == want
