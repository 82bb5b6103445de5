"""Command line: units of a book, their texts and blocks, and a reading of all units."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import blocks, packages
from .plans import reading
from .sources import index, reader, store
from .sources.backend import backend_of


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="marginalia", description=__doc__)
    commands = p.add_subparsers(dest="command", required=True)
    texts = (("index", "units of a book"), ("extract", "the text of a unit"), ("split-blocks", "blocks of a unit"), ("source-index", "blocks of all units"), ("run-reading", "reads all units into a registry"), ("validate-result", "checks an extraction of a unit"))
    for name, text in texts:
        c = commands.add_parser(name, help=text)
        c.add_argument("book")
        if name in ("extract", "split-blocks", "validate-result"):
            c.add_argument("unit")
        if name == "validate-result":
            c.add_argument("json")
            c.add_argument("--repair-payload", action="store_true", help="prints what a model is asked to mend")
        if name == "source-index":
            c.add_argument("--save", metavar="FOLDER", help="writes the index")
        if name == "run-reading":
            c.add_argument("folder")
            c.add_argument("--scope", choices=("book", "unit"), default="book")
            c.add_argument("--backend", choices=("rules", "http"), default="rules")
            for option in ("url", "model", "key"):
                c.add_argument(f"--{option}", default="")
    return p


def unit_line(unit_id: str, label: str, chars: int) -> str:
    return f"{unit_id}\t{chars}\t{label}"


def block_line(unit_id: str, index: int, start: int, end: int, text_hash: str) -> str:
    return f"{unit_id}\t{index}\t{start}\t{end}\t{text_hash[:12]}"


def report_lines(total: dict, found: list[dict], issues: list[dict]) -> list[str]:
    """A report in lines: the verdict, the quotes by status, the issues."""
    head = f"{'passed' if total['passed'] else 'failed'}: {total['error_count']} errors, {total['warning_count']} warnings"
    quotes = ", ".join(f"{k} {n}" for k, n in packages.location_summary(found).items())
    return [head, f"quotes: {quotes}", *(f"{i['severity']}\t{i['code']}\t{i['path']}\t{i['message']}" for i in issues)]


def validate_result(text: str, unit_id: str, file: str, payload: bool) -> tuple[int, str]:
    """Exit code and output for an extraction in a file: 1 if it has errors, 2 if it is no JSON."""
    try:
        data = json.loads(Path(file).read_text(encoding="utf-8"))
    except (OSError, ValueError) as e:
        return 2, f"{file}: {e}"
    issues, found = packages.extraction_issues(data, text, unit_id)
    total = packages.summary(issues)
    out = json.dumps(packages.repair_payload(unit_id, issues, found), ensure_ascii=False, indent=2) if payload else "\n".join(report_lines(total, found, issues))
    return int(not total["passed"]), out


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("marginalia").getOrCreate()
    units = reader.units_of(spark, a.book)
    if a.command == "index":
        for r in units.orderBy("unit_id").select("unit_id", "label", F.length("text").alias("n")).toLocalIterator():
            print(unit_line(r.unit_id, r.label, r.n))
        return 0
    if a.command == "run-reading":
        backend = backend_of(a.backend, a.url, a.model, a.key)
        print(reading.run_reading(spark, units.select("unit_id", "text"), backend, a.folder, a.scope, lambda line: print(line, file=sys.stderr))["summary"])
        return 0
    if a.command == "source-index" and a.save:
        digest = index.file_digests(spark, a.book).first()["digest"]
        built = index.build(units.select("unit_id", "text"), store.book_id(a.book), a.book, digest, a.book.rpartition(".")[2])
        print(index.save(spark, built, a.save), built["meta"]["source_index_id"], built["meta"]["block_count"])
        return 0
    some = units if a.command == "source-index" else units.where(F.col("unit_id") == a.unit)
    if some.isEmpty():
        print(f"no unit {a.unit}", file=sys.stderr)
        return 1
    if a.command == "extract":
        print(some.first().text)
    elif a.command == "validate-result":
        code, out = validate_result(some.first().text, a.unit, a.json, a.repair_payload)
        print(out)
        return code
    else:
        for r in blocks.source_blocks(some, "unit_id").orderBy("unit_id", "block_index").toLocalIterator():
            print(block_line(r.unit_id, r.block_index, r.start, r.end, r.text_hash))
    return 0


if __name__ == "__main__":
    sys.exit(main())
