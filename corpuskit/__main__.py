"""``python -m corpuskit download|pipeline|rebuild|check``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="corpuskit")
    sub = top.add_subparsers(dest="command", required=True)
    p = sub.add_parser("download", help="fetch the shards of a paths file")
    p.add_argument("paths")
    p.add_argument("target")
    p.add_argument("--tasks", type=int, default=4)
    p.add_argument("--offset", type=int, default=0)
    p = sub.add_parser("pipeline", help="make a corpus of shards")
    p.add_argument("source")
    p.add_argument("target")
    p.add_argument("--lid-path", help="a fastText model; without one function words decide")
    p.add_argument("--blocklist")
    p.add_argument("--language-models", help="folder of ARPA files named by language")
    p = sub.add_parser("rebuild", help="make a corpus again of its index and the shards")
    p.add_argument("index")
    p.add_argument("source")
    p.add_argument("target")
    p.add_argument("--lang")
    p = sub.add_parser("check", help="word frequencies of a corpus")
    p.add_argument("source")
    p.add_argument("target")
    return top


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"corpuskit {a.command}").getOrCreate()
    if a.command == "download":
        from corpuskit.sources.download import download, error_log, read_paths
        from corpuskit.storage import written

        results = written(download(read_paths(spark, a.paths), a.target, a.tasks, a.offset), "download")
        error_log(results).write.mode("overwrite").text(f"{a.target}/errors.txt")
        return int(not results.where("error is not null").isEmpty())
    if a.command == "pipeline":
        from corpuskit.functions.arpa import models_in
        from corpuskit.operators.identify import FastTextIdentifier
        from corpuskit.plans.corpus import run
        from corpuskit.sources.blocklist import read_blocklist

        run(
            spark,
            a.source,
            a.target,
            identifier=FastTextIdentifier(a.lid_path) if a.lid_path else None,
            blocklist=read_blocklist(spark, a.blocklist) if a.blocklist else None,
            models=models_in(a.language_models) if a.language_models else None,
        )
    elif a.command == "rebuild":
        from corpuskit.plans.corpus import run_rebuild

        run_rebuild(spark, a.index, a.source, a.target, a.lang)
    else:
        from corpuskit.operators.zipf import ranking, statistics, word_counts
        from corpuskit.sources.writers import read_documents
        from corpuskit.storage import written

        counts = written(word_counts(read_documents(spark, a.source), "content"), "words")
        ranking(counts).write.option("header", "true").csv(a.target)
        print(*statistics(counts).first().asDict().items(), sep="\n")
    return 0


if __name__ == "__main__":
    sys.exit(main())
