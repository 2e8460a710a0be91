"""Command line: `python -m tessera convert|ingest|evaluate|migrate|validate ..`, also by spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.model.profiles import PROFILES, family_of
from tessera.operators import validate
from tessera.operators.points import PointStore, hash_client, service_client
from tessera.plans import jobs
from tessera.sources import documents


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tessera")
    commands = parser.add_subparsers(dest="command", required=True)
    convert = commands.add_parser("convert", help="documents to Markdown")
    convert.add_argument("path")
    convert.add_argument("--out", required=True)
    convert.add_argument("--prefix", choices=sorted(PROFILES))
    ingest = commands.add_parser("ingest", help="Markdown to JSON documents, and points with --upsert")
    ingest.add_argument("folder")
    ingest.add_argument("--out", required=True)
    ingest.add_argument("--prefix", choices=sorted(PROFILES), default="ISA")
    ingest.add_argument("--upsert", action="store_true")
    ingest.add_argument("--store", default=None)
    ingest.add_argument("--collection", default=jobs.UPSERT_OPTIONS["collection"])
    ingest.add_argument("--dim", type=int, default=4096)
    ingest.add_argument("--embed-url", default=None, help="an embedding service; without one, vectors are made of the texts' hashes")
    ingest.add_argument("--embed-key", default=None)
    ingest.add_argument("--batch-size", type=int, default=jobs.UPSERT_OPTIONS["batch_size"])
    ingest.add_argument("--dry-run", action="store_true")
    ingest.add_argument("--prune-stale", action="store_true")
    ingest.add_argument("--metrics-out", default=None)
    ingest.add_argument("--all", action="store_true", help="every family of the folder, going on where one fails")
    evaluation = commands.add_parser("evaluate", help="retrieval of a golden set from a collection")
    evaluation.add_argument("golden")
    evaluation.add_argument("--store", required=True)
    evaluation.add_argument("--collection", default=jobs.UPSERT_OPTIONS["collection"])
    evaluation.add_argument("--dim", type=int, default=4096)
    evaluation.add_argument("--embed-url", default=None)
    evaluation.add_argument("--embed-key", default=None)
    evaluation.add_argument("--out", required=True)
    migration = commands.add_parser("migrate", help="JSON documents to the schema's new version")
    migration.add_argument("folder")
    migration.add_argument("--out", required=True)
    check = commands.add_parser("validate", help="distributions and ids of JSON documents")
    check.add_argument("path")
    check.add_argument("--out", required=True)
    a = parser.parse_args(args)
    spark = SparkSession.builder.appName("tessera").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "convert":
        family = spark.range(1).select(family_of(F.lit(a.path.rstrip("/").rsplit("/", 1)[-1]), a.prefix).alias("f")).first()["f"]
        jobs.convert(spark, a.path, family, a.out)
    elif a.command == "ingest":
        jobs.check_options(a.upsert, store=a.store, collection=a.collection, batch_size=a.batch_size, dry_run=a.dry_run, prune_stale=a.prune_stale, metrics_out=a.metrics_out)
        if not a.upsert:
            documents.write_documents(jobs.ingest(spark, a.folder, a.prefix), a.out)
            return 0
        client = service_client(a.embed_url, a.embed_key) if a.embed_url else hash_client(a.dim)
        runs = jobs.ingest_all(spark, a.folder, PointStore(spark, a.store), client, None if a.all else [a.prefix], a.out, dim=a.dim, default_collection=a.collection, batch=a.batch_size, dry_run=a.dry_run, prune=a.prune_stale)
        if a.metrics_out:
            jobs.write_metrics(jobs.run_metrics(runs.withColumnRenamed("family", "standard_id")), a.metrics_out)
        return int(runs.where("failed > 0").count() > 0)
    elif a.command == "evaluate":
        client = service_client(a.embed_url, a.embed_key) if a.embed_url else hash_client(a.dim)
        rows, by, whole = jobs.evaluate_golden(documents.read_golden(spark, a.golden), PointStore(spark, a.store).read(a.collection), client, a.dim)
        for name, df in (("queries", rows.drop("query_vector")), ("metrics", by), ("totals", whole)):
            jobs.write_metrics(df, f"{a.out}/{name}")
    elif a.command == "migrate":
        jobs.migrate(spark, a.folder, a.out).groupBy("outcome").count().show()
    else:
        chunks = documents.read_documents(spark, a.path).select(F.explode("chunks").alias("c")).select("c.*")
        jobs.write_metrics(validate.id_report(chunks).join(F.broadcast(validate.token_stats(chunks))), f"{a.out}/report")
        validate.distributions(chunks, ["kind", "section", "appendix_index"]).orderBy("name", F.desc("n")).coalesce(1).write.mode("overwrite").json(f"{a.out}/distributions")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
