"""Books and pages as structural units: plain text, EPUB archives and HTML."""

from __future__ import annotations

import codecs
import html
import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import text as T
from ..functions import vocab as V
from ..operators.skew import running, salted_join
from ..operators.spans import heading_islands
from ..storage import ship, written

FALLBACK_BYTES = 65536
_BLANKS = re.compile(r"[ \t]+")
_VOID = {"br", "hr", "img", "input", "link", "meta", "area", "base", "col", "embed", "source", "track", "wbr"}


# Plain text


_LINES = "path string, line int, start_byte long, text string"


def _lines(data: bytes) -> Iterator[tuple[int, str]]:
    """``start_byte, text`` of each line; bytes that the encoding does not know become replacement characters."""
    encoding, mark = sniff_encoding(data[:SNIFFED])
    newline, width = "\n".encode(encoding), len("a".encode(encoding))
    at = len(mark)
    while True:
        end = data.find(newline, at)
        while end >= 0 and (end - len(mark)) % width:
            end = data.find(newline, end + 1)
        yield at, data[at : len(data) if end < 0 else end].decode(encoding, "replace")
        if end < 0:
            return
        at = end + len(newline)


def _whole_lines(files: DataFrame) -> DataFrame:
    """Lines of files (``path, content``), each file in one step of work."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"], strict=True):
                rows = [(p, k, at, text) for k, (at, text) in enumerate(_lines(bytes(content)), 1)]
                for k in range(0, len(rows), 100_000):
                    yield pd.DataFrame(rows[k : k + 100_000], columns=["path", "line", "start_byte", "text"])

    return files.mapInPandas(run, _LINES)


@F.pandas_udf(StringType())
def _encoding_of(head: pd.Series) -> pd.Series:
    return head.map(lambda x: sniff_encoding(bytes(x))[0])


@F.pandas_udf(StringType())
def _decoded(raw: pd.Series, encoding: pd.Series) -> pd.Series:
    return pd.Series([bytes(x).decode(e, "replace") for x, e in zip(raw, encoding, strict=True)], dtype=object)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``path, line, start_byte, text`` of text files in any encoding, lines from 1; ``start_byte`` counts from the file's start.

    Spark cuts files at line ends, so many tasks read a large one; numbers and offsets are running sums over ranges of lines. What a file's encoding is, is told
    from its first lines, about ``SNIFFED`` bytes. Only files of two- or four-byte encodings, where a byte of a character may look like a line's end, are read whole.
    Files without a byte, which Spark passes over, have no lines.
    """
    ship(spark)
    place = F.col("_metadata.file_path").alias("place")
    files = spark.read.format("binaryFile").load(path).select("path", place, F.col("length").alias("size"))  # no contents are read
    cut = spark.read.option("lineSep", "\n").text(path).select(place, F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), F.col("value").cast("binary").alias("raw"))
    rows = written(running(cut, "place", ["block", "row"], F.octet_length("raw") + 1, number="line", before="at").select("place", "line", "at", "raw"), "lines")
    total = rows.groupBy("place").agg(F.count("*").alias("n"), F.sum(F.octet_length("raw") + 1).cast("long").alias("bytes"))
    first = rows.where(F.col("at") < SNIFFED).groupBy("place").agg(F.array_sort(F.collect_list(F.struct("line", "raw"))).alias("first"))
    head = F.aggregate("first", F.lit(b""), lambda x, r: F.concat(x, r["raw"], F.lit(b"\n")))
    told = first.select("place", _encoding_of(F.substring(head, 1, SNIFFED)).alias("encoding"))
    known = files.join(total, "place", "left").join(told, "place", "left").withColumn("bytes", F.coalesce("bytes", F.lit(0))).withColumn("n", F.coalesce("n", F.lit(0)))
    # the reader takes a UTF-8 mark off, and a last line's end, if there is one, is counted already
    known = known.withColumn("mark", F.when(F.col("bytes") < F.col("size"), len(codecs.BOM_UTF8)).otherwise(0))
    known = known.withColumn("encoding", F.when(F.col("mark") > 0, "utf-8").otherwise(F.coalesce("encoding", F.lit("utf-8"))))
    known = written(known.withColumn("whole", F.col("encoding").rlike("(?i)utf.?(16|32)")), "files")
    split = known.where(~F.col("whole"))
    lines = salted_join(rows, split.select("place", "path", "encoding", "mark"), ["place"], F.col("line"))
    lines = lines.select("path", F.col("line").cast("int").alias("line"), (F.col("at") + F.col("mark")).alias("start_byte"), _decoded("raw", "encoding").alias("text"))
    ended = split.where(F.col("bytes") + F.col("mark") == F.col("size")).select("path", (F.col("n") + 1).cast("int").alias("line"), F.col("size").alias("start_byte"), F.lit("").alias("text"))
    wide = spark.read.format("binaryFile").load(path).select("path", "content").join(known.where("whole").select("path"), "path", "left_semi")
    return lines.unionByName(ended).unionByName(_whole_lines(wide))


def text_units(lines: DataFrame, sizes: DataFrame) -> DataFrame:
    """Units of text files: one for each heading, up to the next one; a file without any is cut every 64 KiB.

    ``sizes``: ``path, size``. Columns: ``path, unit_id, label, kind, source_kind, start_byte, end_byte, start_line``.
    """
    found = lines.withColumn("h", T.heading(F.col("text"))).where("h IS NOT NULL").select("path", "line", "start_byte", "h.label", "h.kind")
    kept = heading_islands(found.withColumnRenamed("path", "unit_id")).withColumnRenamed("unit_id", "path")
    nxt = F.lead("start_byte").over(Window.partitionBy("path").orderBy("start_byte"))
    headed = kept.withColumn("next", nxt).join(sizes, "path").select("path", "label", "kind", F.lit("heading").alias("source_kind"), "start_byte", F.coalesce("next", "size").alias("end_byte"), F.col("line").alias("start_line"))
    rest = sizes.join(kept.select("path").distinct(), "path", "left_anti")
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(FALLBACK_BYTES).cast("long"))).alias("start_byte")
    chunks = rest.select("path", "size", chunk).select(
        "path", F.concat(F.lit("chunk "), (F.col("start_byte") / FALLBACK_BYTES + 1).cast("int")).alias("label"), F.lit("section").alias("kind"), F.lit("fallback_chunk").alias("source_kind"), "start_byte",
        F.least(F.col("start_byte") + FALLBACK_BYTES, F.col("size")).alias("end_byte"), F.lit(None).cast("int").alias("start_line"),
    )
    units = headed.unionByName(chunks)
    number = F.row_number().over(Window.partitionBy("path").orderBy("start_byte"))
    return units.withColumn("unit_id", F.format_string("unit-%04d", number)).withColumn("content_kind", T.content_kind(F.col("label"), F.col("kind"), F.col("source_kind")))


def with_texts(units: DataFrame, files: DataFrame) -> DataFrame:
    """``path, unit_id, label, text`` of units (``path, unit_id, label, start_byte, end_byte``) of files (``path, content``): each file meets its units once."""
    ship(units.sparkSession)
    ranges = units.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("start_byte", "end_byte", "unit_id", "label"))).alias("units"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, content, some in zip(pdf["path"], pdf["content"], pdf["units"], strict=True):
                data = bytes(content)
                encoding, _ = sniff_encoding(data[:SNIFFED])
                yield pd.DataFrame([(p, u["unit_id"], u["label"], data[u["start_byte"] : u["end_byte"]].decode(encoding, "replace").lstrip("\ufeff")) for u in some], columns=["path", "unit_id", "label", "text"])

    return files.join(ranges, "path").select("path", "content", "units").mapInPandas(run, "path string, unit_id string, label string, text string")


#: Bytes by which an encoding is told.
SNIFFED = 1 << 20
_BOMS = [(codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF32_LE, "utf-32-le"), (codecs.BOM_UTF32_BE, "utf-32-be"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be")]
_DECLARED = re.compile(rb"""(?:encoding=["']|charset=["']?)([A-Za-z0-9._-]+)""", re.IGNORECASE)
_HAN = re.compile("[\u4e00-\u9fff\u3000-\u303f\uff00-\uffef]")


def _decodes(head: bytes, encoding: str) -> str | None:
    """The text of bytes that are all of an encoding, but for a character cut at the end; else nothing."""
    try:
        return codecs.getincrementaldecoder(encoding)().decode(head)
    except (UnicodeDecodeError, LookupError):
        return None


def sniff_encoding(head: bytes) -> tuple[str, bytes]:
    """The encoding of a file by how it begins, and its byte order mark.

    A mark decides; else two-byte forms where every other byte of much of it is zero; else UTF-8 if the bytes are; else the Chinese
    forms, if nearly all that is not ASCII then reads as Chinese; else the Western one. No library is asked, so all workers agree.
    """
    for mark, name in _BOMS:
        if head.startswith(mark):
            return name, mark
    zeros = [head[k::2].count(0) for k in (0, 1)]
    if max(zeros) * 4 > len(head) // 2 > 0:
        return ("utf-16-be" if zeros[0] > zeros[1] else "utf-16-le"), b""
    if _decodes(head, "utf-8") is not None:
        return "utf-8", b""
    for name in ("gb18030", "big5"):
        other = [c for c in _decodes(head, name) or "" if ord(c) > 127]
        if other and len(_HAN.findall("".join(other))) >= 0.9 * len(other):
            return name, b""
    return "cp1252", b""


def html_encoding(data: bytes) -> str:
    """The encoding that a page declares among its first bytes, if it is a known one, else UTF-8."""
    for mark, name in _BOMS:
        if data.startswith(mark):
            return name
    found = _DECLARED.search(data[:4096])
    try:
        return codecs.lookup(found[1].decode()).name if found else "utf-8"
    except LookupError:
        return "utf-8"


def decoded_page(data: bytes) -> str:
    return data.decode(html_encoding(data), "replace").lstrip("\ufeff")


# HTML


class _Flattener(HTMLParser):
    """Text of a page, a line for each block; scripts, styles and comments are left out. Inline pieces follow each other directly."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.size = 0
        self.anchors: dict[str, int] = {}
        self.headings: list[tuple[int, str, str | None, int]] = []
        self.title = ""
        self.hidden = 0
        self.in_body = self.in_title = False
        self.open: tuple[int, list[str], str | None, int] | None = None

    def _push(self, piece: str) -> None:
        self.pieces.append(piece)
        self.size += len(piece)

    def _line(self) -> None:
        if self.pieces and not self.pieces[-1].endswith("\n"):
            self._push("\n")

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "body":
            self.pieces, self.size, self.anchors, self.headings, self.in_body = [], 0, {}, [], True
        self.in_title = tag == "title"
        if tag in ("script", "style"):
            self.hidden += 1
        if tag in V.BLOCK_TAGS:
            self._line()
        named = dict(attrs)
        name = named.get("id") or named.get("name")
        if name:
            self.anchors.setdefault(name, self.size)
        if re.fullmatch("h[1-6]", tag):
            self.open = (int(tag[1]), [], name, self.size)
        if tag in _VOID and tag in V.BLOCK_TAGS:
            self._line()

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)
        if tag == "title":
            self.in_title = False
        if self.open and re.fullmatch("h[1-6]", tag):
            level, said, name, at = self.open
            label = _tidy(" ".join(said))
            if label:
                self.headings.append((level, label, name, at))
            self.open = None
        if tag in V.BLOCK_TAGS:
            self._line()

    def handle_data(self, data: str) -> None:
        if self.in_title:
            self.title = self.title or _tidy(data)
            return
        if self.hidden:
            return
        piece = _tidy(data)
        if piece:
            if self.open:
                self.open[1].append(piece)
            self._push(piece)


def _tidy(text: str) -> str:
    return _BLANKS.sub(" ", html.unescape(text.replace("\xa0", " ")).replace("\r", "")).strip()


def flatten_html(page: str) -> dict:
    """``text, title, headings, anchors`` of a page; the title is the first heading, else the head's."""
    f = _Flattener()
    f.feed(page)
    f.close()
    text = re.sub(r"\n{3,}", "\n\n", "".join(f.pieces)).strip()
    return {"text": text, "title": f.headings[0][1] if f.headings else f.title, "headings": f.headings, "anchors": f.anchors}


_FLAT = "page_id long, text string, title string, headings array<struct<level:int,label:string,anchor:string,char_offset:int>>, n_anchors int"


def flatten_pages(pages: DataFrame) -> DataFrame:
    """``flatten_html`` of each row of ``page_id, html``; null counts as empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            flat = [flatten_html(x or "") for x in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"], "text": [x["text"] for x in flat], "title": [x["title"] for x in flat], "headings": [[dict(zip(("level", "label", "anchor", "char_offset"), h, strict=True)) for h in x["headings"]] for x in flat], "n_anchors": [len(x["anchors"]) for x in flat]})

    ship(pages.sparkSession)
    return pages.select("page_id", "html").mapInPandas(run, _FLAT)


def strip_tags(page: Column) -> Column:
    """A plainer form that stays in the JVM: scripts, styles, comments and tags become line breaks."""
    t = F.regexp_replace(page, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", "\n")
    t = F.regexp_replace(F.regexp_replace(t, r"(?s)<!--.*?-->", "\n"), r"(?s)<[^>]*>", "\n")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"[ \t]+", " "), r"\n\s*", "\n"), r"^\s+|\s+$", "")


# EPUB

_UNITS = "path string, unit_id string, ord int, level int, parent_id string, label string, source_kind string, spine_index int, char_offset int, end_spine_index int, end_char_offset int, text string"


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1].lower()


def _xml(data: bytes) -> ElementTree.Element:
    """Parses without a document type, so no entity is ever resolved."""
    return ElementTree.fromstring(re.sub(rb"<!DOCTYPE[^>\[]*(\[[^\]]*\])?[^>]*>", b"", data))


class Epub:
    """The spine, the table of contents and the metadata of an archive."""

    def __init__(self, data: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(data))
        container = _xml(self.zip.read("META-INF/container.xml"))
        self.opf = next(e.attrib["full-path"] for e in container.iter() if _local(e.tag) == "rootfile")
        package = _xml(self.zip.read(self.opf))
        self.base = posixpath.dirname(self.opf)
        items = [e.attrib for e in package.iter() if _local(e.tag) == "item" and "id" in e.attrib and "href" in e.attrib]
        self.manifest = {a["id"]: a for a in items}
        refs = [e.attrib.get("idref", "") for e in package.iter() if _local(e.tag) == "itemref"]
        # The place in the spine stays as it is, so it may have gaps.
        self.spine = [(k, self._path(self.manifest[r]["href"])) for k, r in enumerate(refs) if r in self.manifest and "html" in self.manifest[r].get("media-type", "html")]
        # Title, creator and language as the package says.
        self.metadata = {_local(e.tag): (e.text or "").strip() for e in package.iter() if _local(e.tag) in ("title", "creator", "language")}
        self.docs = {k: flatten_html(decoded_page(self.zip.read(p))) for k, p in self.spine}
        self.place = {p: k for k, p in self.spine}

    def _path(self, href: str, base: str | None = None) -> str:
        return posixpath.normpath(posixpath.join(self.base if base is None else base, href))

    def toc(self) -> list[tuple[int, str, str, str]]:
        """``depth, label, path, anchor`` in reading order: from the navigation document, else from the NCX."""
        for a in self.manifest.values():
            if "nav" in a.get("properties", "").split():
                path = self._path(a["href"])
                entries = self._nav(_xml(self.zip.read(path)), posixpath.dirname(path))
                if entries:
                    return entries
        for a in self.manifest.values():
            if a.get("media-type") == "application/x-dtbncx+xml":
                path = self._path(a["href"])
                return list(self._ncx(_xml(self.zip.read(path)), posixpath.dirname(path), 1))
        return []

    def _entry(self, depth: int, label: str, href: str, base: str) -> tuple[int, str, str, str]:
        target, _, anchor = href.partition("#")
        return depth, _tidy(label), self._path(target, base), anchor

    def _nav(self, root: ElementTree.Element, base: str) -> list[tuple[int, str, str, str]]:
        out: list[tuple[int, str, str, str]] = []

        def walk(node: ElementTree.Element, depth: int) -> None:
            for child in node:
                tag = _local(child.tag)
                if tag == "a" and "href" in child.attrib:
                    out.append(self._entry(depth, "".join(child.itertext()), child.attrib["href"], base))
                else:
                    walk(child, depth + (tag == "ol"))

        for nav in root.iter():
            if _local(nav.tag) == "nav" and "toc" in " ".join(nav.attrib.values()):
                walk(nav, 0)
                break
        return out

    def _ncx(self, node: ElementTree.Element, base: str, depth: int) -> Iterator[tuple[int, str, str, str]]:
        for child in node:
            if _local(child.tag) == "navpoint":
                label = next(("".join(e.itertext()) for e in child if _local(e.tag) == "navlabel"), "")
                href = next((e.attrib.get("src", "") for e in child if _local(e.tag) == "content"), "")
                yield self._entry(depth, label, href, base)
                yield from self._ncx(child, base, depth + 1)
            elif _local(child.tag) == "navmap":
                yield from self._ncx(child, base, depth)

    def reconciled(self) -> list[tuple[int, str, tuple[int, int]]]:
        """``depth, label, position`` of the entries. An entry whose label is a later document's title, but whose target is not, goes to that document."""
        titles = {k: re.sub(r"[\s　]+", "", d["title"]).lower() for k, d in self.docs.items()}
        out, least = [], 0
        for depth, label, path, anchor in self.toc():
            at = self.place.get(path)
            wanted = re.sub(r"[\s　]+", "", label).lower()
            if at is None or titles[at] != wanted:
                at, anchor = next(((k, "") for k, t in titles.items() if k >= least and t and t == wanted), (at, anchor))
            if at is None:
                continue
            least = max(least, at)
            doc = self.docs[at]
            offset = doc["anchors"].get(anchor, 0) if anchor else 0
            before = [h[3] for h in doc["headings"] if h[3] <= offset]
            out.append((depth, label, (at, max(before) if anchor and before else offset)))
        return out

    def text(self, start: tuple[int, int], end: tuple[int, int] | None) -> str:
        parts = []
        for k, _ in self.spine:
            if k < start[0] or (end and k > end[0]):
                continue
            t = self.docs[k]["text"]
            piece = t[start[1] if k == start[0] else 0 : end[1] if end and k == end[0] else len(t)].strip()
            if piece:
                parts.append(piece)
        return "\n\n".join(parts)

    def units(self) -> list[tuple]:
        """Rows of the units: those of the table of contents, each up to the next entry that is no deeper; else a unit for each document."""
        entries = self.reconciled() or [(1, self.docs[k]["title"] or posixpath.basename(p), (k, 0)) for k, p in self.spine]
        kind = "toc" if self.toc() else "spine"
        rows, open_ = [], []
        for n, (depth, label, start) in enumerate(entries):
            end = next((s for d, _, s in entries[n + 1 :] if d <= depth and s > start), None)
            while open_ and open_[-1][0] >= depth:
                open_.pop()
            ident = f"unit-{n + 1:04d}"
            rows.append((ident, n + 1, depth, open_[-1][1] if open_ else "book", label, kind, *start, *(end or (None, None)), self.text(start, end)))
            open_.append((depth, ident))
        return rows


def epub_units(spark: SparkSession, path: str) -> DataFrame:
    """The units of EPUB archives with their texts, one task for each archive."""
    names = [f.split()[0] for f in _UNITS.split(", ")][1:]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"], strict=True):
                out = pd.DataFrame(Epub(bytes(content)).units(), columns=names)
                for c in ("end_spine_index", "end_char_offset"):
                    out[c] = out[c].astype("Int32")
                out.insert(0, "path", p)
                yield out

    ship(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, _UNITS)


def epub_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``path, title, creator, language, n_documents`` of EPUB archives."""
    ship(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            books = [Epub(bytes(c)) for c in pdf["content"]]
            yield pd.DataFrame({"path": pdf["path"], **{k: [b.metadata.get(k, "") for b in books] for k in ("title", "creator", "language")}, "n_documents": [len(b.spine) for b in books]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, title string, creator string, language string, n_documents long")


def units_of(spark: SparkSession, path: str) -> DataFrame:
    """``path, unit_id, label, text`` of a book by its suffix."""
    suffix = posixpath.splitext(path)[1].lower()
    if suffix == ".epub":
        return epub_units(spark, path).select("path", "unit_id", "label", "text")
    if suffix != ".txt":
        raise ValueError(f"not a book: {path}")
    files = spark.read.format("binaryFile").load(path)
    units = text_units(text_lines(spark, path), files.select("path", F.col("length").alias("size")))
    return with_texts(units, files.select("path", "content"))


def content_units(units: DataFrame) -> DataFrame:
    """Units (``unit_id, parent_id, kind``) that no other has as parent; if all have, all but the root."""
    leaves = units.join(units.select(F.col("parent_id").alias("unit_id")).where("unit_id IS NOT NULL").distinct(), "unit_id", "left_anti").where("kind <> 'book'")
    return units.where("kind <> 'book'") if leaves.isEmpty() else leaves
