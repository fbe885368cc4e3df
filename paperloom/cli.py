"""Command line: ``python -m paperloom.cli COMMAND --base STORE ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom import schema
from paperloom.operators import corpus, dedup
from paperloom.operators.store import CorpusStore
from paperloom.plans.collect import collect, search
from paperloom.sources import files
from paperloom.sources.querylang import with_suffix

STRATEGIES = ("keep-recent", "keep-fulltext", "merge", "export")


def resolved(papers: DataFrame, strategy: str) -> DataFrame:
    return dedup.merge_groups(papers) if strategy == "merge" else dedup.keep_one(papers, strategy == "keep-fulltext")


def dedup_command(store: CorpusStore, args) -> None:
    """Without --apply only the plan is shown; older snapshots stay, so what is applied can be taken back."""
    papers = store.read("papers")
    if args.strategy == "export":
        files.write_array(dedup.export_groups(papers), args.out)
    elif args.apply:
        print("snapshot", store.write("papers", resolved(papers, args.strategy)))
    else:
        dedup.plan(
            papers, args.strategy == "keep-fulltext"
        ).orderBy("doi", "action", "pmid").show(args.rows, truncate=False)


def merge_command(store: CorpusStore, args) -> None:
    out = corpus.merge_stores(CorpusStore(store.spark, args.source).read("papers"), store.read("papers"))
    out.groupBy("action").count().show()
    if args.apply:
        print("snapshot", store.write("papers", out.drop("action")))


def reclean_command(store: CorpusStore, args) -> None:
    papers = store.read("papers")
    if not args.apply:
        corpus.reclean_preview(papers).show(truncate=False)
        return
    new = corpus.reclean(papers)
    kept = papers.join(new.select("pmid"), "pmid", "left_anti")
    changed = papers.drop("abstract", "full_text").join(new, "pmid").select(*papers.columns)
    print("snapshot", store.write("papers", kept.unionByName(changed)))


def run_command(spark: SparkSession, args) -> None:
    """Every query of a configuration over a table of papers, into the store of its output folder (``--base`` without one)."""
    conf = files.config(spark, args.config)
    folders = files.output_folders(conf["output_dir"] or args.base, conf["test_db"])
    log = files.tee_log("paperloom", args.log) if args.log else None
    papers, works = spark.read.parquet(args.papers), spark.read.parquet(args.works)
    lacking = [f for f in schema.paper() if f.name not in papers.columns]
    papers = papers.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacking})
    with CorpusStore(spark, folders["store"]) as store:
        for query in conf["queries"]:
            query = with_suffix(query, conf["queries_suffix"]) if conf["use_suffix"] else query
            ids = corpus.guard(search(papers, query, conf["max_results"]), conf["check_num"])
            now = spark.range(1).select(F.current_timestamp().cast("string")).first()[0]
            run = collect(store, papers.join(ids, "pmid", "left_semi"), works, query, now, now, conf["description"])
            (log.info if log else print)(corpus.run_summary(run))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="paperloom", description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)
    commands = {
        n: sub.add_parser(n) for n in (
            "stats", "duplicates", "dedup", "merge", "reclean", "search", "export", "failed", "cache", "restore", "run"
        )
    }
    for p in commands.values():
        p.add_argument("--base", required=True, help="folder of the store")
        p.add_argument("--rows", type=int, default=20)
    for n in ("dedup", "merge", "reclean"):
        commands[n].add_argument("--apply", action="store_true")
    commands["dedup"].add_argument("--strategy", choices=STRATEGIES, default="keep-recent")
    commands["merge"].add_argument("--source", required=True)
    commands["search"].add_argument("query")
    commands["search"].add_argument("--max-results", type=int, default=50_000)
    for n in ("config", "papers", "works"):
        commands["run"].add_argument(f"--{n}", required=True)
    commands["run"].add_argument("--log")
    commands["restore"].add_argument("--version", type=int, required=True)
    commands["cache"].add_argument("--clear", action="store_true")
    for n in ("dedup", "export", "failed"):
        commands[n].add_argument("--out")
    args = parser.parse_args(argv)
    spark = spark or SparkSession.builder.appName("paperloom").getOrCreate()
    with CorpusStore(spark, args.base) as store:
        match args.command:
            case "stats":
                store.statistics().show()
            case "duplicates":
                dedup.report(store.read("papers")).show()
            case "dedup":
                dedup_command(store, args)
            case "merge":
                merge_command(store, args)
            case "reclean":
                reclean_command(store, args)
            case "search":
                search(store.read("papers"), args.query, args.max_results).show(args.rows, truncate=False)
            case "export":
                files.write_array(store.read("papers"), args.out)
            case "failed":
                files.write_lines(corpus.failed_export(store.read("papers")), "line", args.out)
            case "cache":
                if args.clear:
                    print("snapshot", store.clear_cache())
                else:
                    store.cache_info().show()
                    store.cache_entries().show(args.rows, truncate=False)
            case "run":
                run_command(spark, args)
            case "restore":
                print("snapshot", store.restore("papers", args.version))


if __name__ == "__main__":
    main()
