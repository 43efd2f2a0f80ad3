"""Commands: the batch stages, blocks and their knowledge base, classification, questions, reports.

    python -m clausewise.cli pipeline --reviews FILE --places FILE --out DIR [--skip-swap] [--from N] --sentiment M:F --embedding M:F
    python -m clausewise.cli cluster --clauses DIR --out DIR [--distance D] [--min-size N] [--dry]
    python -m clausewise.cli kb --blocks FILE --ledger DIR --out DIR [--limit N]
    python -m clausewise.cli classify --blocks DIR --ledger DIR --cache DIR --out DIR [--fine] [--limit N] [--report-only]
    python -m clausewise.cli visualise --clusters DIR --out FILE [--report-only]
    python -m clausewise.cli report --clusters DIR
    python -m clausewise.cli ask --clauses DIR --embedding M:F "question" [--json] [--max-clauses N] [--interactive]
    python -m clausewise.cli reviews --reviews DIR --places FILE "question" [--json] [--max-reviews N] [--interactive]

``M:F`` names a provider: the module M has a callable F, which is called without arguments.  Relative
paths are taken against ``--folder``, by default the working folder.  The chat endpoint comes from
CHAT_URL, CHAT_MODEL and CHAT_KEY, also from a file ``.env`` in the folder.
"""

from __future__ import annotations

import argparse
import importlib
import json
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from clausewise.operators import clusters as C
from clausewise.operators import html_report
from clausewise.operators import knowledge as KB
from clausewise.operators import taxonomy as T
from clausewise.operators.ledger import Ledger
from clausewise.operators.providers import http_chat
from clausewise.plans import pipeline
from clausewise.sources import readers, writers


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="clausewise")
    top.add_argument("--folder", default=".")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name, *needed, **optional):
        c = commands.add_parser(name)
        for option in needed:
            c.add_argument(option, required=True)
        for option, default in optional.items():
            flag = "--" + option.replace("_", "-")
            if default is False:
                c.add_argument(flag, action="store_true")
            else:
                c.add_argument(flag, type=type(default) if default is not None else str, default=default)
        return c

    for name, table, limit, more in (("ask", "--clauses", "--max-clauses", {"embedding": None}), ("reviews", "--reviews", "--max-reviews", {})):
        c = command(name, json=False, interactive=False, **more)
        c.add_argument(table, dest="table", required=True)
        c.add_argument(limit, dest="most", type=int, default=15)
        c.add_argument("question", nargs="?")
        if name == "reviews":
            c.add_argument("--places", required=True)
    command("pipeline", "--reviews", "--places", "--out", skip_swap=False, sentiment=None, embedding=None).add_argument("--from", dest="start", type=int, default=1)
    command("cluster", "--clauses", "--out", distance=0.45, min_size=3, dry=False)  # dry: count the blocks, write none
    command("kb", "--blocks", "--ledger", "--out", limit=0)
    command("classify", "--blocks", "--ledger", "--cache", "--out", fine=False, limit=0, report_only=False)
    command("visualise", "--clusters", "--out", report_only=False)
    command("report", "--clusters")
    return top


def named(name: str | None, what: str):
    """The provider that ``module:callable`` makes."""
    if not name or ":" not in name:
        raise SystemExit(f"--{what} module:callable names the {what} provider")
    module, _, maker = name.partition(":")
    return getattr(importlib.import_module(module), maker)()


def shown(answer: dict, as_json: bool) -> str:
    if as_json:
        return json.dumps(answer, ensure_ascii=False, default=str)
    sources = answer.get("source_clauses") or answer.get("source_reviews") or []
    return "\n".join([answer["summary"], *(f"- {a}" for a in answer["actions"]), f"({len(sources)} sources)"])


def main(argv: list[str] | None = None, spark: SparkSession | None = None, provider=None, embed=None, out=sys.stdout, lines=sys.stdin,
         sentiment=None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    at = lambda path: readers.resolve(path, args.folder)

    def chat():
        if provider is not None:
            return provider
        readers.load_env(at(".env"))
        return http_chat(os.environ["CHAT_URL"], os.environ["CHAT_MODEL"], os.environ.get("CHAT_KEY", ""))

    def ledger() -> Ledger:
        return Ledger(spark, at(args.ledger), chat(), os.environ.get("CHAT_MODEL", ""))

    def validated() -> None:
        print(json.dumps(C.validation_report(spark.read.parquet(at(args.clusters))).first().asDict()), file=out)

    if args.command == "pipeline":
        times: dict = {}
        pipeline.run(spark, readers.csv(spark, at(args.reviews)), readers.csv(spark, at(args.places)), sentiment or named(args.sentiment, "sentiment"),
                     embed or named(args.embedding, "embedding"), skip_swap=args.skip_swap, start=args.start, folder=at(args.out), times=times)
        for stage, seconds in times.items():
            print(f"{stage}: {seconds:.1f}s", file=out)
        return 0
    if args.command == "cluster":
        rows = spark.read.parquet(at(args.clauses))
        found = rows.join(C.clusters(rows, args.distance), "seq")
        made = C.blocks(found.select("seq", "cluster", F.col("clause_text").alias("text"), F.col("place_name").alias("place")), args.min_size)
        if args.dry:
            print(made.count(), "blocks", file=out)
        else:
            made.write.mode("overwrite").parquet(at(args.out))
        return 0
    if args.command == "kb":
        entries = KB.knowledge_base(readers.block_lines(spark, at(args.blocks)), ledger(), limit=args.limit)
        writers.jsonl(entries, at(args.out))
        print(spark.read.json(at(args.out)).count(), "entries", file=out)
        return 0
    if args.command == "classify":
        known = writers.read_cache(spark, at(args.cache)) if os.path.isdir(at(args.cache)) else None
        new = KB.classify(spark.read.parquet(at(args.blocks)), ledger(), fine=args.fine, cache=known, report_only=args.report_only, limit=args.limit)
        if not args.report_only:
            writers.append_cache(new, at(args.cache))
        rows = writers.read_cache(spark, at(args.cache))
        writers.jsonl(T.fine_report(rows, T.fine_dim(spark)) if args.fine else T.report(rows, T.coarse_dim(spark)), at(args.out))
        return 0
    if args.command in ("report", "visualise"):
        validated()
        if args.command == "visualise" and not args.report_only:
            rows = spark.read.parquet(at(args.clusters))
            page = html_report.scatter_page(html_report.neighbour_layout(rows.select("seq", "cluster", "embedding", F.col("clause_text").alias("text"))))
            with open(at(args.out), "w", encoding="utf-8") as f:
                f.write(page)
        return 0
    places = readers.first_column(spark, at(args.places), header=True) if args.command == "reviews" else None
    embed = embed or (named(args.embedding, "embedding") if args.command == "ask" else None)
    engine = KB.Engine(spark.read.parquet(at(args.table)), embed, chat(), places)
    ask = engine.ask if args.command == "ask" else engine.ask_reviews
    if args.question:
        print(shown(ask(args.question, args.most), args.json), file=out)
    if args.interactive:
        for line in lines:
            if line.strip().lower() in ("", "quit", "exit"):
                break
            print(shown(ask(line.strip(), args.most), args.json), file=out)
    return 0 if args.question or args.interactive else 2


if __name__ == "__main__":
    raise SystemExit(main())
