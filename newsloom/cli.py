"""Command line: python -m newsloom.cli STAGE ...; each stage reads paths and writes paths."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from newsloom.functions.sentiment import compound
from newsloom.functions.text import last_days_path
from newsloom.operators import corpus, trends
from newsloom.plans import flows
from newsloom.schemas import ARTICLE
from newsloom.sources import digest, taxonomy
from newsloom.sources.stages import read_articles, write_stage


def _all(spark, path):
    return spark.read.parquet(path)


def _terms(spark, paths):
    """Terms of one or more taxonomies, their ids made unique by the file's place."""
    out = None
    for k, path in enumerate(paths):
        one = taxonomy.read_taxonomy(spark, path).withColumn("RISK_ID", F.col("RISK_ID") + (0 if len(paths) == 1 else 1_000_000 * k))
        out = one if out is None else out.unionByName(one)
    return out


def ingest(spark, a):
    """Stories of digests or structured files as article rows, merged into the corpus."""
    items = digest.read_digests(spark, a.input).withColumn("link", F.lit("")) if a.raw else digest.read_structured(spark, a.input)
    items = items.select("title", F.col("summary").alias("text"), "source", "date", "link", F.concat("section", F.when(F.col("paywalled"), ":paywalled").otherwise("")).alias("category"))
    rows = corpus.normalise(items, "EMAIL", "email:", compound(F.concat_ws(" ", "title", "text")))
    rows = rows.withColumn("seq", F.monotonically_increasing_id())
    if a.corpus:
        old = read_articles(spark, a.corpus).withColumn("seq", F.col("GOOGLE_INDEX").cast("long"))
        rows = corpus.upsert(old, rows, corpus.link_or_title_key())
    else:
        rows = corpus.first_of(rows, corpus.link_or_title_key(), "seq").withColumn("_gen", F.lit(0))
    out = corpus.renumbered(rows, "_gen", "seq")
    write_stage(out.withColumn("GOOGLE_INDEX", F.col("GOOGLE_INDEX").cast("int")).select(*ARTICLE.fieldNames()), a.out)


def topics(spark, a):
    labels = taxonomy.risk_map(_terms(spark, [a.taxonomy])) if a.taxonomy else None
    articles, summary = flows.cluster(read_articles(spark, a.input), a.work, a.nr_topics, a.days, labels, a.cut)
    out = last_days_path(a.out, a.days)
    write_stage(articles, f"{out}/articles")
    write_stage(summary, f"{out}/summary")


def trend(spark, a):
    months, topic_rows, by_risk = trends.build_trends(_all(spark, a.input), a.drop_benign)
    write_stage(months, f"{a.out}/months")
    write_stage(topic_rows, f"{a.out}/topics")
    write_stage(by_risk, f"{a.out}/by_risk")


def gap(spark, a):
    write_stage(flows.gap_table(_all(spark, a.input), _terms(spark, [a.taxonomy]), a.min_quality), a.out)


def discover(spark, a):
    articles = corpus.lane(_all(spark, a.input), a.source)
    write_stage(flows.discovery_table(articles, _terms(spark, a.taxonomy), a.min_quality), a.out)


def grid(spark, a):
    write_stage(flows.status_grid(_all(spark, a.input), a.as_of, a.min_volume), a.out)


def payload(spark, a):
    write_stage(flows.report_payload(_all(spark, a.input), _all(spark, a.summary)), a.out)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="newsloom", description=__doc__)
    stages = top.add_subparsers(required=True)

    def stage(name, run):
        one = stages.add_parser(name, help=run.__doc__)
        one.add_argument("--input", required=True)
        one.add_argument("--out", required=True)
        one.set_defaults(run=run)
        return one

    p = stage("ingest", ingest)
    p.add_argument("--raw", action="store_true", help="digests as text; else a structured CSV")
    p.add_argument("--corpus", help="merge into this corpus")
    p = stage("topics", topics)
    p.add_argument("--work", required=True)
    p.add_argument("--nr-topics", type=int, help="so many centres; without it the density of the stories tells")
    p.add_argument("--days", type=int)
    p.add_argument("--taxonomy")
    p.add_argument("--cut", type=float, default=0.8, help="with --nr-topics: stories further from their centre are outliers")
    p = stage("trends", trend)
    p.add_argument("--drop-benign", action="store_true")
    p = stage("gaps", gap)
    p.add_argument("--taxonomy", required=True)
    p.add_argument("--min-quality", type=float, default=0.6)
    p = stage("discover", discover)
    p.add_argument("--taxonomy", nargs="+", required=True)
    p.add_argument("--source", default="LEXICON")
    p.add_argument("--min-quality", type=float, default=0.6)
    p = stage("status", grid)
    p.add_argument("--as-of", help="the running month, yyyy-MM")
    p.add_argument("--min-volume", type=float, default=10.0)
    p = stage("payload", payload)
    p.add_argument("--summary", required=True)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(spark or SparkSession.builder.appName("newsloom").getOrCreate(), args)


if __name__ == "__main__":
    main()
