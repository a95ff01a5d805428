"""Command line: python -m textloom scan-pdf | ingest | curate | query."""

from __future__ import annotations

import argparse
import sys
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.config import Curate, Ingest


def session(name: str) -> SparkSession:
    return SparkSession.builder.appName(f"textloom {name}").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _settings(parser: argparse.ArgumentParser, kind) -> None:
    for f in fields(kind):
        flag = "--" + f.name.replace("_", "-")
        if isinstance(f.default, bool):
            parser.add_argument(flag, action=argparse.BooleanOptionalAction, default=f.default)
        else:
            parser.add_argument(flag, type=type(f.default), default=f.default)


def _taken(args, kind):
    return kind(**{f.name: getattr(args, f.name) for f in fields(kind)})


def ingest(rows: DataFrame, at: str, settings: Ingest) -> DataFrame:
    """Texts (key, text, source) checked, cut into windows of words, the first of equal ones, with vectors; batches that are whole are not made again."""
    from textloom.functions.embedding import embed_column
    from textloom.operators.labels import strip, words
    from textloom.sources import stores

    w = words(F.col("text"))
    letters = F.length(F.regexp_replace(strip(F.col("text")), r"[^\p{L}]", ""))
    good = rows.where((F.length(strip(F.col("text"))) >= settings.min_chars) & (F.size(w) >= settings.min_words) & (letters / F.length(strip(F.col("text"))) >= 1 - settings.max_non_alpha))
    step = max(1, settings.chunk_size - settings.overlap)
    single = (F.size(w) <= settings.chunk_size) & (F.length("text") <= settings.max_chars)
    cut = F.transform(F.sequence(F.lit(0), F.size(w) - 1, F.lit(step)), lambda i: F.substring(F.array_join(F.slice(w, i + 1, settings.chunk_size), " "), 1, settings.max_chars))
    chunks = good.select("key", "source", F.posexplode(F.when(single, F.array("text")).otherwise(cut)).alias("chunk_id", "text")).where(F.length("text") >= settings.min_chars)
    first = chunks.groupBy(F.md5("text").alias("id")).agg(F.min_by(F.struct("key", "source", "chunk_id", "text"), F.struct("key", "chunk_id")).alias("r")).select("id", "r.*")
    return stores.in_batches(first, "id", at, lambda b: b.withColumn("embedding", embed_column(F.col("text"))), settings.batches)


def curate(turns: DataFrame, out: str, settings: Curate) -> DataFrame:
    """Turns (conv_id, turn, role, text) as pairs of the gate's score, split by falling score in shuffled blocks, written with a summary. Returns the splits."""
    from textloom.operators import dialogue, labels
    from textloom.operators.connectors import data_summary
    from textloom.operators.labels import stored, strip, words
    from textloom.plans.ranking import split_blocks
    from textloom.sources import sinks

    s = strip(F.col("text"))
    other = 1 - F.length(F.regexp_replace("text", r"[^\p{L}]", "")) / F.length("text")
    good = turns.where(F.length(s).between(settings.min_chars, settings.max_chars) & (F.size(words(F.col("text"))) >= settings.min_words) & (other <= settings.max_non_alpha))
    known = labels.labelled(labels.candidates(good.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")))
    pairs = stored(dialogue.conversational_pairs(good, known, settings.pair_gate).withColumn("source", F.lit("conversation")), "curated")
    placed = split_blocks(pairs, "id", "score", train=settings.train, validation=settings.validation).select("id", "split")
    rows = stored(pairs.join(placed, "id"), "splits")
    # Within a split the first of equal texts stays.
    rows = rows.groupBy("split", F.md5("text").alias("h")).agg(F.min_by(F.struct(*[c for c in rows.columns if c != "split"]), "id").alias("r")).select("split", "r.*")
    meta = F.struct(F.col("conv_id").cast("string").alias("conversation_id"), F.col("turn").cast("string").alias("message_id"), "source", "themes")
    sinks.write_splits(rows.select("split", "text", F.col("user").alias("input"), F.col("assistant").alias("output"), meta.alias("source_metadata")), f"{out}/dataset", gzip=settings.gzip)
    sinks.write_splits(rows, f"{out}/dataset_detailed", gzip=settings.gzip)
    data_summary(rows).write.mode("overwrite").json(f"{out}/summary")
    return rows


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="textloom", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    scan = commands.add_parser("scan-pdf", help="texts of the PDF files below a folder, as JSON lines")
    scan.add_argument("folder")
    scan.add_argument("out")
    take = commands.add_parser("ingest", help="chat exports or page documents as embedded chunks")
    take.add_argument("kind", choices=["chats", "pages"])
    take.add_argument("path")
    take.add_argument("out")
    _settings(take, Ingest)
    make = commands.add_parser("curate", help="chat exports as training pairs in splits")
    make.add_argument("path")
    make.add_argument("out")
    _settings(make, Curate)
    ask = commands.add_parser("query", help="a registered query over a folder of tables, as Parquet")
    ask.add_argument("name")
    ask.add_argument("tables")
    ask.add_argument("out")
    args = parser.parse_args(argv)
    spark = session(args.command)
    if args.command == "scan-pdf":
        from textloom.sources import pdf, stores

        stores.write_documents(pdf.assemble(pdf.read_pages(pdf.scan_folder(spark, args.folder))), args.out)
    elif args.command == "ingest":
        from textloom.sources import chat, stores

        if args.kind == "chats":
            rows = chat.read_chats(spark, args.path).select(F.concat_ws("/", "conversation_id", "message_id").alias("key"), "text", F.lit("conversation").alias("source"))
        else:
            rows = stores.read_documents(spark, args.path).select(F.col("filename").alias("key"), "text", F.lit("pdf").alias("source"))
        ingest(rows, args.out, _taken(args, Ingest))
    elif args.command == "curate":
        from textloom.sources import chat

        found = chat.read_chats(spark, args.path)
        curate(found.select(F.pmod(F.xxhash64("conversation_id"), F.lit(1 << 52)).alias("conv_id"), F.col("ordinal").alias("turn"), F.col("author").alias("role"), "text"), args.out, _taken(args, Curate))
    else:
        from textloom.plans import catalogue

        catalogue.queries()[args.name](spark, args.tables).write.mode("overwrite").parquet(args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
