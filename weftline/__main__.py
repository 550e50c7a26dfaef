"""``python -m weftline build ROOT FOLDER``, ``ask FOLDER QUESTION [--scope S]``, ``sql FOLDER QUERY``, ``profile FOLDER``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from weftline.graph import Graph, build
from weftline.plans import ask, profile
from weftline.plans.guard import is_query, writes


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="weftline")
    sub = parser.add_subparsers(dest="do", required=True)
    make = sub.add_parser("build")
    make.add_argument("root")
    make.add_argument("folder")
    make.add_argument("--chunk", type=int, default=1200)
    make.add_argument("--strict", action="store_true", help="read what the notation means where the reader has known limits")
    question = sub.add_parser("ask")
    question.add_argument("folder")
    question.add_argument("question")
    question.add_argument("--scope", choices=ask.SCOPES, default="local")
    run = sub.add_parser("sql")
    run.add_argument("folder")
    run.add_argument("query")
    sub.add_parser("profile").add_argument("folder")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if args.do == "build":
        build(spark, args.root, args.chunk, strict=args.strict).save(args.folder)
        Graph.load(spark, args.folder).summary().show()
        return 0
    graph = Graph.load(spark, args.folder)
    if args.do == "ask":
        chunks = graph.chunks.withColumn("doc_id", F.col("full_doc_id"))
        print(ask.Retriever(graph.entities, graph.relations, chunks, graph.documents, graph.communities).ask(args.question, args.scope).show())
    elif args.do == "sql":
        if writes(args.query) or not is_query(spark, args.query):
            print("refused: only queries run here")
            return 1
        graph.sql(args.query).show(ask.TOP_K, truncate=False)
    else:
        print(profile.survey(profile.probes(graph.entities, graph.relations, graph.documents, graph.chunks, graph.communities)))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
