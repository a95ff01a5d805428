"""Sources and sinks as queries: tables written in a source's or sink's form to the shared folder, read back, and told by SQL over the tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.embedding import HashedWords, embed_column
from textloom.operators import dialogue, labels
from textloom.operators.labels import _CONV, stored
from textloom.operators.text import t1_windows
from textloom.sources import chat, pdf, sinks, stores
from textloom.sources.scratch import scratch


def _read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# PDF folders: a conversation is a file, a turn a page after the contents; a page is its title in letters of 14 and its text in letters of 10.


def _pdf_folder(spark, sf_dir, damaged: str = "false", name: str = "pdf") -> str:
    """A folder of all conversations as PDF files, those for which ``damaged`` holds without a page tree."""
    at = scratch(spark, name)
    turns = _read(spark, sf_dir, "conversations").withColumn("damaged", F.expr(damaged))

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(at) if ":/" in at else (fs.LocalFileSystem(), at)
        for frame in frames:
            for conv, pages, bad in frame.itertuples(index=False):
                turns_ = sorted(pages, key=lambda p: p["turn"])
                toc = [("Contents", 14.0)] + [(f"{i + 1}.{p['turn']} {p['role'].title()} turn ..... {i + 2}", 10.0) for i, p in enumerate(turns_)]
                made = [toc] + [[(f"{p['role'].title()} Turn", 14.0)] + [(x, 10.0) for x in p["text"].split("\n")] for p in turns_]
                store.create_dir(f"{root}/{conv % 7}", recursive=True)
                with store.open_output_stream(f"{root}/{conv % 7}/conv-{conv}.pdf") as out:
                    out.write(pdf.make_pdf(made, damaged=bool(bad), packed=conv % 2 == 0))
            yield frame[["conv_id"]]

    files = turns.groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role", "text")).alias("pages"), F.max("damaged").alias("damaged"))
    stored(files.mapInPandas(write, "conv_id long"), "pdf-names")  # one conversation a row
    return at


def s1_pdf_pages(spark, sf_dir):
    pages = pdf.read_pages(pdf.scan_folder(spark, _pdf_folder(spark, sf_dir)))
    return pages.select("filename", "page", F.md5("text").alias("text_md5"), "method")


def s2_fallback(spark, sf_dir):
    """Files without a page tree are read whole; of the others, the pages are counted."""
    pages = pdf.read_pages(pdf.scan_folder(spark, _pdf_folder(spark, sf_dir, "conv_id % 3 = 0")))
    return pages.groupBy("filename", "method").agg(F.count("page").alias("n_pages"), F.md5(F.max(F.when(F.col("method") == "whole", F.col("text")))).alias("whole_md5"))


def s3_assembly(spark, sf_dir):
    """Pages joined; two files that are no PDF have failed."""
    files = pdf.scan_folder(spark, _pdf_folder(spark, sf_dir))
    other = spark.createDataFrame([("broken.pdf", bytearray(b"%PDF-1.4 nothing here")), ("empty.pdf", bytearray(b""))], "filename string, content binary")
    found = pdf.assemble(pdf.read_pages(files.unionByName(other)))
    return found.select("filename", "n_pages", "status", F.md5("total_text").alias("text_md5"))


def s4_directory(spark, sf_dir):
    """The PDF files below a folder with its own subfolders; files of other names are not read."""
    at = _pdf_folder(spark, sf_dir)
    spark.createDataFrame([("no document",)], "value string").write.mode("overwrite").text(f"{at}/notes")
    return pdf.scan_folder(spark, at).select("filename", (F.length("content") > 0).alias("filled"))


def s5_rich(spark, sf_dir):
    """Counts of what is read, before rules of cleaning join or drop words."""
    found = pdf.rich_documents(pdf.read_pages(pdf.scan_folder(spark, _pdf_folder(spark, sf_dir, "conv_id % 3 = 0"))), clean=labels.strip)
    return found.select("filename", "word_count", "page_count", (F.col("char_count") >= F.col("word_count")).alias("sane"))


def t6_sections(spark, sf_dir):
    """Titles in large letters, by layout."""
    return pdf.sections(pdf.read_pages(pdf.scan_folder(spark, _pdf_folder(spark, sf_dir)))).select("filename", "title", "page", "size")


def t7_contents(spark, sf_dir):
    return pdf.contents(pdf.read_pages(pdf.scan_folder(spark, _pdf_folder(spark, sf_dir))))


def _structure(pages: DataFrame) -> DataFrame:
    """(filename, title, page): sections, then entries of the contents."""
    w = Window.partitionBy("filename").orderBy("kind", "page", "line")
    found = pdf.sections(pages).select("filename", "title", "page", "line", F.lit(0).alias("kind"))
    toc = pdf.contents(pages).select("filename", "title", F.col("page").cast("int").alias("page"), F.lit(0).alias("line"), F.lit(1).alias("kind"))
    return found.unionByName(toc).withColumn("place", F.row_number().over(w).cast("long")).drop("line")


def u5_structure(spark, sf_dir):
    pages = pdf.read_pages(pdf.scan_folder(spark, _pdf_folder(spark, sf_dir)))
    return _structure(pages).select("filename", "place", "title", "page", F.when(F.col("kind") == 0, "section").otherwise("contents").alias("kind"))


def j3_sections(spark, sf_dir):
    """Each chunk of a file's text with its section: the first title within its first 200 characters, else the title whose page is nearest by share."""
    pages = stored(pdf.read_pages(pdf.scan_folder(spark, _pdf_folder(spark, sf_dir))), "j3-pages")
    known = _structure(pages).groupBy("filename").agg(F.array_sort(F.collect_list(F.struct("place", "title", "page"))).alias("titles"))
    words = F.filter(F.split("total_text", r"(?U)\s+"), lambda w: w != "")
    rows = pdf.assemble(pages).select("filename", words.alias("w")).where(F.size("w") > 0).join(known, "filename", "left")
    chunks = rows.select("filename", "titles", "w", F.posexplode(F.sequence(F.lit(0), F.size("w") - 1, F.lit(400))).alias("chunk_index", "first"), F.ceil(F.size("w") / 400).alias("n"))
    head = F.lower(F.substring(F.array_join(F.slice("w", F.col("first") + 1, 500), " "), 1, 200))
    within = F.get(F.filter("titles", lambda t: F.contains(head, F.lower(t["title"]))), F.lit(0))["title"]
    near = F.array_min(F.transform("titles", lambda t: F.struct(F.abs(F.col("chunk_index") / F.col("n") - t["page"] / 100.0).alias("d"), t["place"].alias("place"), t["title"].alias("title"))))["title"]
    return chunks.select("filename", F.col("chunk_index").cast("long").alias("chunk_index"), F.coalesce(within, near).alias("section"))


# JSON exports.


def _exports(spark, sf_dir) -> DataFrame:
    """(file, shape, j): each conversation as an export of one of five shapes, by its number."""
    turns = _read(spark, sf_dir, "conversations")
    roles = "CASE role WHEN 'user' THEN 'Human' WHEN 'assistant' THEN 'ai' ELSE role END"
    m = turns.select(
        "conv_id", "turn", F.expr(roles).alias("who"), "text", F.format_string("m%d", "turn").alias("mid"), (F.col("turn") + 1700000000).cast("string").alias("stamp")
    )
    items = lambda s: F.array_sort(F.collect_list(F.struct("turn", s.alias("x"))))
    body = m.groupBy("conv_id").agg(
        items(F.to_json(F.struct(F.col("mid").alias("uuid"), F.col("who").alias("sender"), "text", F.col("stamp").alias("created_at")))).alias("s0"),
        items(F.concat(F.lit('"'), "mid", F.lit('":'), F.to_json(F.struct(F.struct(F.struct(F.col("who").alias("role")).alias("author"), F.struct(F.array("text").alias("parts")).alias("content"), F.col("stamp").cast("double").alias("create_time")).alias("message"))))).alias("s1"),
        items(F.to_json(F.struct(F.col("who").alias("role"), F.array(F.struct("text")).alias("content"), F.col("stamp").alias("timestamp")))).alias("s2"),
        items(F.to_json(F.struct(F.col("who").alias("author"), F.array("text").alias("content"), F.col("stamp").alias("time")))).alias("s3"),
        items(F.to_json(F.struct(F.col("who").alias("role"), F.struct("text").alias("message"), F.col("stamp").alias("timestamp")))).alias("s4"),
    )
    joined = lambda c: F.array_join(F.transform(c, lambda x: x["x"]), ",")
    c = F.col("conv_id").cast("string")
    shape = F.pmod("conv_id", F.lit(5))
    j = (
        F.when(shape == 0, F.concat(F.lit('[{"uuid":"'), c, F.lit('","chat_messages":['), joined("s0"), F.lit("]}]")))
        .when(shape == 1, F.concat(F.lit('{"id":"'), c, F.lit('","mapping":{'), joined("s1"), F.lit("}}")))
        .when(shape == 2, F.concat(F.lit('{"conversations":[{"id":"'), c, F.lit('","messages":['), joined("s2"), F.lit("]}]}")))
        .when(shape == 3, F.concat(F.lit('{"'), c, F.lit('":['), joined("s3"), F.lit("]}")))
        .otherwise(F.concat(F.lit('{"id":"'), c, F.lit('","messages":['), joined("s4"), F.lit("]}")))
    )
    return body.select(F.col("conv_id").alias("file"), shape.alias("shape"), j.alias("j"))


def _chats(files: DataFrame) -> DataFrame:
    return chat.chats(files.select(F.expr("try_parse_json(j)").alias("v"), "file"))


def s6_chats(spark, sf_dir):
    """All conversations as exports of five shapes, read again."""
    return _chats(_exports(spark, sf_dir)).select("conversation_id", "ordinal", "author", F.md5("text").alias("text_md5"))


def s7_mapping(spark, sf_dir):
    return _chats(_exports(spark, sf_dir).where("shape = 1")).select("conversation_id", "message_id", "author", F.md5("text").alias("text_md5"))


def p4_content(spark, sf_dir):
    """Texts from a string, first parts, a text field, a list of strings, a list of texts."""
    rows = _read(spark, sf_dir, "conversations").withColumn("k", F.pmod(F.col("turn"), F.lit(5)))
    made = [F.to_json(F.struct(F.col("text").alias("c"))), F.to_json(F.struct(F.struct(F.array("text", F.lit("no")).alias("parts")).alias("c"))), F.to_json(F.struct(F.struct("text").alias("c"))), F.to_json(F.struct(F.array("text", F.lit("more")).alias("c"))), F.to_json(F.struct(F.array(F.struct("text"), F.struct(F.lit("more").alias("text"))).alias("c")))]
    j = F.coalesce(*[F.when(F.col("k") == i, x) for i, x in enumerate(made)])
    return rows.select("conv_id", "turn", j.alias("j")).selectExpr("conv_id", "turn", "try_variant_get(parse_json(j), '$.c', 'variant') AS c").selectExpr("conv_id", "turn", f"md5({chat._content('c')}) AS text_md5")


def p6_timestamp(spark, sf_dir):
    """Times of messages, whichever field a shape keeps them in; empty and zero count as missing."""
    return _chats(_exports(spark, sf_dir)).select("conversation_id", "ordinal", F.col("timestamp").cast("double").cast("long").alias("stamp"))


def s13_profile(spark, sf_dir):
    return stores.profiled(_exports(spark, sf_dir)).select("file", "format", "kind", "length", "keys")


def s14_estimate(spark, sf_dir):
    return stores.profiled(_exports(spark, sf_dir)).select("file", "expected")


# Documents, data sets and stores.


def k1_documents(spark, sf_dir):
    """Documents written whole and in short; both read back."""
    at = scratch(spark, "k1")
    docs = pdf.assemble(pdf.read_pages(pdf.scan_folder(spark, _pdf_folder(spark, sf_dir))))
    stores.write_documents(docs, at)
    whole = spark.read.schema("filename string, total_text string, n_pages long, status string").json(f"{at}/detailed")
    short = stores.read_documents(spark, f"{at}/simple").withColumnRenamed("text", "short")
    return whole.join(short, "filename").select("filename", "n_pages", "status", F.md5("total_text").alias("whole_md5"), F.md5("short").alias("simple_md5"))


def s8_documents(spark, sf_dir):
    """Page documents under four field names, chunked as at ingestion."""
    from textloom.functions.dialect import Spark

    at = scratch(spark, "s8")
    docs = _read(spark, sf_dir, "documents")
    names = ["text", "content", "total_text", "body"]
    j = F.coalesce(*[F.when(F.pmod("doc_id", F.lit(4)) == i, F.to_json(F.struct(F.col("doc_id").cast("string").alias("filename"), F.lit(7).alias("text" if n != "text" else "other"), F.col("text").alias(n)) if n != "text" else F.struct(F.col("doc_id").cast("string").alias("filename"), F.col("text")))) for i, n in enumerate(names)])
    docs.select(j.alias("value")).write.text(at)
    stores.read_documents(spark, at).select(F.col("filename").cast("long").alias("doc_id"), "text").createOrReplaceTempView("page_documents")
    return spark.sql(t1_windows(Spark()).replace("documents", "page_documents"))


def s9_custom(spark, sf_dir):
    """A list of texts with their metadata, in memory."""
    items = [{"text": f"Custom text number {i} of an application", "metadata": {"source": "custom", "rank": str(i)}} for i in range(100)]
    rows = spark.createDataFrame([(x["text"], x["metadata"]) for x in items], "text string, metadata map<string,string>")
    return rows.select("text", F.element_at("metadata", "source").alias("source"), F.element_at("metadata", "rank").cast("long").alias("rank"))


def s10_store(spark, sf_dir):
    """Turns and documents as a store in which fields lack by their numbers, validated."""
    maybe = lambda cond, column: F.when(cond, column)  # noqa: E731 - null fields are not written
    turns = _read(spark, sf_dir, "conversations").withColumn("item_id", F.col("conv_id") * 1000 + F.col("turn"))
    meta = F.struct(F.lit("conversation").alias("source"), maybe(F.col("item_id") % 5 != 0, F.col("role")).alias("author"), maybe(F.col("item_id") % 3 != 0, F.col("conv_id").cast("string")).alias("conversation_id"), maybe(F.col("item_id") % 2 != 0, F.col("turn").cast("string")).alias("timestamp"))
    first = turns.select("item_id", "text", F.to_json(meta).alias("metadata"))
    docs = _read(spark, sf_dir, "documents").withColumn("item_id", -F.col("doc_id") - 1)
    meta = F.struct(maybe(F.col("doc_id") % 4 != 0, F.lit("pdf")).alias("source"), maybe(F.col("doc_id") % 3 != 0, F.col("source")).alias("filename"))
    second = docs.select("item_id", F.when(F.col("doc_id") % 11 != 0, F.col("text")).otherwise("").alias("text"), F.when(F.col("doc_id") % 13 != 0, F.to_json(meta)).otherwise("[]").alias("metadata"))
    at = scratch(spark, "s10")
    first.unionByName(second).write.parquet(at)
    found = stores.validated(spark.read.parquet(at))
    return found.select("item_id", F.md5("text").alias("text_md5"), "metadata.*")


def _split_of(key: Column) -> Column:
    return F.when(F.pmod(key, F.lit(10)) < 8, "train").when(F.pmod(key, F.lit(10)) == 8, "validation").otherwise("test")


def _pairs(spark, sf_dir) -> DataFrame:
    """All pairs with their scores, the answers' themes and a split."""
    known = labels.labelled(labels.candidates(labels.turns(spark, sf_dir)))
    found = dialogue.conversational_pairs(_read(spark, sf_dir, "conversations"), known, gate=0.0)
    return found.withColumn("split", _split_of(F.col("conv_id") + F.col("turn")))


def k3_splits(spark, sf_dir):
    """Splits written for training and in detail, and read back."""
    at = scratch(spark, "k3")
    rows = _pairs(spark, sf_dir).select("conv_id", "turn", "split", "text", F.col("user").alias("input"), F.col("assistant").alias("output"), F.round("score", 5).alias("score"), "themes")
    sinks.write_splits(rows.select("split", "text", "input", "output", F.struct(F.col("conv_id").cast("string").alias("conversation_id"), F.col("turn").cast("string").alias("message_id")).alias("source_metadata")), at)
    sinks.write_splits(rows, at + "_detailed", gzip=True)
    plain = spark.read.schema("split string, text string, input string, output string, source_metadata struct<conversation_id: string, message_id: string>").json(at)
    plain = plain.select("split", F.col("source_metadata.conversation_id").cast("long").alias("conv_id"), F.col("source_metadata.message_id").cast("long").alias("turn"), F.md5("text").alias("text_md5"), F.length(F.concat("input", "output")).cast("long").alias("chars"))
    whole = spark.read.schema(rows.schema).json(at + "_detailed").select("split", "conv_id", "turn", F.size("themes").cast("long").alias("n_themes"))
    return plain.join(whole, ["split", "conv_id", "turn"])


def s11_dataset(spark, sf_dir):
    """One split of a data set of JSON lines, by its file's name."""
    at = scratch(spark, "s11")
    rows = _read(spark, sf_dir, "documents").select(_split_of(F.col("doc_id")).alias("split"), "doc_id", "text")
    sinks.write_splits(rows, at)
    return spark.read.schema("doc_id long, text string").json(f"{at}/split=validation").select("doc_id", F.md5("text").alias("text_md5"))


def data_summary(rows: DataFrame) -> DataFrame:
    """One row: pairs, pairs a split, quality a split, themes and sources; ``general`` for pairs without themes."""
    def as_map(df: DataFrame, value) -> DataFrame:
        return df.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", value)))).alias("m"))

    counts = lambda df, c: as_map(df.groupBy(c.alias("name")).agg(F.count(F.lit(1)).alias("n")), F.col("n"))
    quality = rows.groupBy(F.col("split").alias("name")).agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"), F.min("score").alias("min"), F.max("score").alias("max"))
    themes = rows.select(F.explode(F.when(F.size("themes") > 0, F.col("themes")).otherwise(F.array(F.lit("general")))).alias("theme"))
    parts = [rows.agg(F.count(F.lit(1)).alias("total_pairs")), counts(rows, F.col("split")).withColumnRenamed("m", "splits"), as_map(quality, F.struct("mean", "std", "min", "max")).withColumnRenamed("m", "quality_stats"),
             counts(themes, F.col("theme")).withColumnRenamed("m", "theme_distribution"), counts(rows, F.col("source")).withColumnRenamed("m", "source_distribution")]
    found = parts[0]
    for p in parts[1:]:
        found = found.crossJoin(F.broadcast(p))  # one row each
    return found


def _summary_store(spark, sf_dir) -> tuple[str, T.StructType]:
    at = scratch(spark, "summary")
    made = data_summary(stored(_pairs(spark, sf_dir).withColumn("source", F.lit("conversation")), "summary-pairs"))
    made.write.json(at)
    return at, made.schema


def k5_summary(spark, sf_dir):
    """The data set's summary, written as JSON and read back: quality of each split."""
    at, schema = _summary_store(spark, sf_dir)
    back = spark.read.schema(schema).json(at)
    rows = back.select("total_pairs", "splits", F.explode("quality_stats").alias("split", "q"))
    return rows.select("split", F.element_at("splits", F.col("split")).alias("n"), "total_pairs", *[F.round(f"q.{c}", 5).alias(c) for c in ("mean", "std", "min", "max")])


def s12_summary(spark, sf_dir):
    """Themes and sources as a summary names them."""
    at, schema = _summary_store(spark, sf_dir)
    back = spark.read.schema(schema).json(at)
    return back.select(F.explode("theme_distribution").alias("name", "n")).withColumn("kind", F.lit("theme")).unionByName(back.select(F.explode("source_distribution").alias("name", "n")).withColumn("kind", F.lit("source")))


def k2_memory(spark, sf_dir):
    """A memory store of documents with their vectors, read back."""
    at = scratch(spark, "k2")
    rows = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), embed_column(F.col("text")).alias("embedding"), "text", F.to_json(F.struct("lang", "source")).alias("metadata"))
    stores.write_memory_store(rows, at, {"dim": 64, "model": "hashed words"})
    back, config = stores.read_memory_store(spark, at, ["id", "embedding", "text", "metadata"])
    return back.select("id", F.size("embedding").cast("long").alias("dim"), F.md5("text").alias("text_md5"), F.get_json_object("metadata", "$.lang").alias("lang"), F.lit(config["model"]).alias("model"))


def k6_checkpoint(spark, sf_dir):
    """Turns embedded once for each text, batch by batch; the run is broken off after three batches and goes on in a second one."""
    at = scratch(spark, "k6")
    rows = _read(spark, sf_dir, "conversations").groupBy(F.md5("text").alias("key")).agg(F.min("text").alias("text"))
    make = lambda b: b.select("key", embed_column(F.col("text")).alias("embedding"))
    stores.in_batches(rows, "key", at, make, 6, stop_after=3)
    return stores.in_batches(rows, "key", at, make, 6).select("key", F.size("embedding").cast("long").alias("dim"))


def k7_batches(spark, sf_dir):
    """Documents embedded in batches that are kept when a run breaks off."""
    at = scratch(spark, "k7")
    rows = _read(spark, sf_dir, "documents").select("doc_id", "text")
    make = lambda b: b.select("doc_id", F.round(F.aggregate(embed_column(F.col("text"), HashedWords(whole=True)), F.lit(0.0), lambda s, x: s + x * x), 6).alias("square"))
    stores.in_batches(rows, "doc_id", at, make, 4, stop_after=1)
    return stores.in_batches(rows, "doc_id", at, make, 4).select("doc_id", "square")


def k8_generations(spark, sf_dir):
    """What two runs learn, saved as generations; the latest is loaded."""
    at = scratch(spark, "k8")
    stores.save_generation(labels.count_names(labels.labelled(labels.candidates(labels.turns(spark, sf_dir)))), at)
    before = stores.load_generation(spark, at)
    stores.save_generation(labels.count_names(labels.labelled(labels.candidates(labels.documents(spark, sf_dir))), before), at)
    return stores.load_generation(spark, at).select("generation", "kind", "name", "n")


def k10_vectors(spark, sf_dir):
    """A stored memory whose vectors of another size are dropped on loading."""
    at = scratch(spark, "k10")
    rows = _read(spark, sf_dir, "embeddings")
    rows.select("vec_id", F.when(F.col("vec_id") % 10 == 0, F.slice("embedding", 1, 32)).otherwise(F.col("embedding")).alias("embedding"), "label").write.parquet(at)
    return spark.read.parquet(at).where(F.size("embedding") == 64).select("vec_id", "label")


def _rewards(spark, sf_dir) -> DataFrame:
    return _read(spark, sf_dir, "events").select(F.col("user_id").alias("name"), F.col("event_id").alias("id"), ((F.col("value") - 50) / 100).alias("reward"), F.unix_micros(F.col("ts").cast("timestamp")).alias("seen"))


def k11_reputation(spark, sf_dir):
    """Reputations saved as JSON and loaded."""
    at = scratch(spark, "k11")
    made = stores.reputations(_rewards(spark, sf_dir))
    made.write.json(at)
    back = spark.read.schema(made.schema).json(at)
    return back.select("name", "n", *[F.round(c, 5).alias(c) for c in ("reward_sum", "reward_sq", "ema_reward")], "last_seen", "failures")


def g17_reputation(spark, sf_dir):
    found = stores.reputations(_rewards(spark, sf_dir))
    return found.select("name", "n", "failures", F.round("ema_reward", 5).alias("ema_reward"), F.round(stores.reputation_score(F.col("n"), F.col("reward_sum"), F.col("reward_sq")), 5).alias("score"))


def k12_audit(spark, sf_dir):
    """Two batches of entries added to one log and read."""
    at = scratch(spark, "k12")
    rows = _read(spark, sf_dir, "events")
    entries = rows.select(F.col("ts").cast("timestamp").alias("timestamp"), "event_type", F.col("user_id").cast("string").alias("user"), F.lit("/run").alias("endpoint"), F.lit(200).alias("status"), F.create_map(F.lit("id"), F.col("event_id").cast("string")).alias("details"), "event_id")
    for half in (0, 1):
        stores.audit(entries.where(F.col("event_id") % 2 == half).drop("event_id"), at)
    back = spark.read.schema("timestamp string, event_type string, user string, endpoint string, status int, details map<string,string>").json(at)
    return back.select(F.element_at("details", "id").cast("long").alias("event_id"), "timestamp", "event_type", "user", "status")


def k13_cache(spark, sf_dir):
    """Tokens from a cache that is damaged at first: it is made again, and then read as it is."""
    at = scratch(spark, "k13")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType())])
    spark.createDataFrame([("damaged",)], "value string").write.text(at)
    docs = _read(spark, sf_dir, "documents")
    make = lambda: docs.select("doc_id", F.least(F.size(F.regexp_extract_all("text", F.lit("[A-Za-z0-9]+|[^A-Za-z0-9 ]"), 0)), F.lit(512)).cast("long").alias("n_tokens"))
    stores.cached(spark, at, schema, make)

    def never():
        raise RuntimeError("the cache is whole")

    return stores.cached(spark, at, schema, never)


def k14_ingest(spark, sf_dir):
    """The first 2,000 documents as items; those with labels are known already."""
    new, count = stores.ingest(_read(spark, sf_dir, "documents").select("doc_id", "lang"), _read(spark, sf_dir, "labels"), "doc_id", "doc_id")
    return new.crossJoin(F.broadcast(count)).select("doc_id", "lang", "count")  # one row


def p2_metadata(spark, sf_dir):
    """Metadata of turns with ids and times as strings and without blank themes, nested metadata alike."""
    inner = F.struct(F.col("conv_id").alias("conversation_id"), F.col("turn").alias("message_id"), (F.col("turn") * 10).alias("timestamp"), F.split("role", "s").alias("themes"))
    rows = _read(spark, sf_dir, "conversations").select(inner.alias("m"))
    meta = stores.normalised_metadata(F.col("m"))
    outer = stores.normalised_metadata(F.struct(F.col("m.conversation_id"), F.col("m.message_id"), F.col("m.timestamp"), F.array(F.lit(" "), F.lit("x")).alias("themes")))
    return rows.select(F.to_json(outer.withField("user_msg", meta)).alias("metadata"))


QUERIES = {
    "S1_pdf_pages": s1_pdf_pages, "S2_pdf_fallback": s2_fallback, "S3_assembly": s3_assembly, "S4_directory_scan": s4_directory, "S5_rich_scan": s5_rich, "S6_chat_scan": s6_chats, "S7_mapping_scan": s7_mapping, "S8_page_documents": s8_documents,
    "S9_custom_source": s9_custom, "S10_memory_store": s10_store, "S11_jsonl_dataset": s11_dataset, "S12_summary_scan": s12_summary, "S13_profile": s13_profile, "S14_size_estimate": s14_estimate, "T6_sections": t6_sections, "T7_contents": t7_contents, "U5_structure": u5_structure,
    "J3_chunk_sections": j3_sections, "P4_content": p4_content, "P6_timestamp": p6_timestamp, "P2_metadata": p2_metadata, "K1_document_sink": k1_documents, "K2_memory_sink": k2_memory, "K3_split_sink": k3_splits, "K5_summary": k5_summary, "K6_embed_checkpoint": k6_checkpoint,
    "K7_batch_checkpoint": k7_batches, "K8_generations": k8_generations, "K10_vector_store": k10_vectors, "K11_reputation_store": k11_reputation, "G17_reputation": g17_reputation, "K12_audit_log": k12_audit, "K13_token_cache": k13_cache, "K14_ingest": k14_ingest,
}

_RANKED = "(SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations)"
_TITLE = "upper(substr(role, 1, 1)) || substr(role, 2)"
_ENTRY = f"r || '.' || turn || ' ' || {_TITLE} || ' turn ..... ' || (r + 1)"
_PAGE = rf"regexp_replace({_TITLE} || ' Turn' || chr(10) || text, '^\s+|\s+$', '', 'g')"
_TOC = f"'Contents' || chr(10) || string_agg({_ENTRY}, chr(10) ORDER BY r)"
_PDF = f"""pages AS (SELECT conv_id, CAST(r + 1 AS INT) AS page, {_PAGE} AS t, {_TITLE} || ' Turn' || chr(10) || text AS raw FROM {_RANKED} k UNION ALL SELECT conv_id, 1 AS page, {_TOC} AS t, {_TOC} AS raw FROM {_RANKED} k GROUP BY conv_id)"""
_NAME = "'conv-' || conv_id || '.pdf'"
_SHAPE_KEYS = "CASE conv_id % 5 WHEN 0 THEN 'chat_messages,uuid' WHEN 1 THEN 'id,mapping' WHEN 2 THEN 'conversations' WHEN 3 THEN CAST(conv_id AS VARCHAR) ELSE 'id,messages' END"
_AUTHOR = "CASE role WHEN 'user' THEN 'user' WHEN 'assistant' THEN 'assistant' ELSE lower(role) END"
_SPLIT = "CASE WHEN {0} % 10 < 8 THEN 'train' WHEN {0} % 10 = 8 THEN 'validation' ELSE 'test' END"
_PAIR_ROWS = f"WITH {_CONV}, pr AS (SELECT * FROM {dialogue._PAIRED.format(src='conversations')} p), {dialogue._assessed('pr', 'conv_id, turn', 'u', 'a')}, w AS (SELECT m.*, l.themes, {_SPLIT.format('(m.conv_id + m.turn)')} AS split FROM m JOIN c_lab l ON l.id = m.conv_id * 1000 + m.turn)"
_REWARDS = "(SELECT user_id AS name, event_id, (value - 50) / 100 AS reward, epoch_us(ts) AS seen, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) - 1 AS back FROM events)"
_REPUTE = f"SELECT name, count(*) AS n, sum(reward) AS s, sum(reward * reward) AS q, max(seen) AS last_seen, sum(0.1e0 * pow(0.9e0, back) * reward) + pow(0.9e0, count(*)) * 0.5e0 AS ema, CAST(sum(CASE WHEN reward < 0 THEN 1 ELSE 0 END) AS BIGINT) AS failures FROM {_REWARDS} x GROUP BY name"

ORACLE_SQL = {
    "S1_pdf_pages": f"WITH {_PDF} SELECT {_NAME} AS filename, page, md5(t) AS text_md5, 'pages' AS method FROM pages",
    "S2_pdf_fallback": rf"""WITH {_PDF} SELECT {_NAME} AS filename, 'pages' AS method, count(*) AS n_pages, NULL AS whole_md5 FROM pages WHERE conv_id % 3 <> 0 GROUP BY conv_id
UNION ALL SELECT {_NAME} AS filename, 'whole' AS method, 1 AS n_pages, md5(regexp_replace(string_agg(raw, chr(10) ORDER BY page), '^\s+|\s+$', '', 'g')) AS whole_md5 FROM pages WHERE conv_id % 3 = 0 GROUP BY conv_id""",
    "S3_assembly": f"""WITH {_PDF} SELECT {_NAME} AS filename, count(*) AS n_pages, 'ok' AS status, md5(string_agg(t, chr(10) || chr(10) ORDER BY page)) AS text_md5 FROM pages GROUP BY conv_id
UNION ALL SELECT 'broken.pdf', 0, 'failed', md5('') UNION ALL SELECT 'empty.pdf', 0, 'failed', md5('')""",
    "S4_directory_scan": f"SELECT DISTINCT {_NAME} AS filename, true AS filled FROM conversations",
    "S5_rich_scan": rf"""WITH {_PDF} SELECT {_NAME} AS filename, CAST(sum(len(list_filter(string_split_regex(t, '\s+'), lambda w: w <> ''))) AS BIGINT) AS word_count, CASE WHEN conv_id % 3 = 0 THEN 1 ELSE count(*) END AS page_count, true AS sane FROM pages GROUP BY conv_id""",
    "T6_sections": f"SELECT {_NAME} AS filename, 'Contents' AS title, 1 AS page, 14e0 AS size FROM (SELECT DISTINCT conv_id FROM conversations) c UNION ALL SELECT {_NAME}, {_TITLE} || ' Turn', CAST(r + 1 AS INT), 14e0 FROM {_RANKED} k",
    "T7_contents": f"SELECT {_NAME} AS filename, r || '.' || turn AS number, {_TITLE} || ' turn' AS title, r + 1 AS page FROM {_RANKED} k",
    "U5_structure": f"""WITH s AS (SELECT conv_id, 1 AS place, 'Contents' AS title, 1 AS page, 'section' AS kind FROM (SELECT DISTINCT conv_id FROM conversations) c UNION ALL SELECT conv_id, r + 1, {_TITLE} || ' Turn', CAST(r + 1 AS INT), 'section' FROM {_RANKED} k
UNION ALL SELECT conv_id, r + 1 + max(r) OVER (PARTITION BY conv_id), {_TITLE} || ' turn', CAST(r + 1 AS INT), 'contents' FROM {_RANKED} k) SELECT {_NAME} AS filename, place, title, page, kind FROM s""",
    "J3_chunk_sections": rf"""WITH {_PDF}, s AS (SELECT conv_id, 1 AS place, 'Contents' AS title, 1 AS page FROM (SELECT DISTINCT conv_id FROM conversations) c UNION ALL SELECT conv_id, r + 1, {_TITLE} || ' Turn', r + 1 FROM {_RANKED} k
UNION ALL SELECT conv_id, r + 1 + max(r) OVER (PARTITION BY conv_id), {_TITLE} || ' turn', r + 1 FROM {_RANKED} k),
d AS (SELECT conv_id, list_filter(string_split_regex(string_agg(t, chr(10) || chr(10) ORDER BY page), '\s+'), lambda x: x <> '') AS w FROM pages GROUP BY conv_id),
c AS (SELECT conv_id, i, ceil(len(w) / 400) AS n, lower(substr(array_to_string(w[i * 400 + 1 : i * 400 + 500], ' '), 1, 200)) AS head FROM (SELECT conv_id, w, unnest(range(0, CAST(ceil(len(w) / 400) AS BIGINT))) AS i FROM d) z),
k AS (SELECT c.conv_id, c.i, s.title, row_number() OVER (PARTITION BY c.conv_id, c.i ORDER BY CASE WHEN contains(head, lower(s.title)) THEN 0 ELSE 1 END, CASE WHEN contains(head, lower(s.title)) THEN 0 ELSE abs(c.i / c.n - s.page / 100e0) END, s.place) AS b FROM c JOIN s ON s.conv_id = c.conv_id)
SELECT {_NAME} AS filename, i AS chunk_index, title AS section FROM k WHERE b = 1""",
    "S6_chat_scan": f"SELECT CAST(conv_id AS VARCHAR) AS conversation_id, r - 1 AS ordinal, {_AUTHOR} AS author, md5(text) AS text_md5 FROM {_RANKED} k",
    "S7_mapping_scan": f"SELECT CAST(conv_id AS VARCHAR) AS conversation_id, CAST(r - 1 AS VARCHAR) AS message_id, {_AUTHOR} AS author, md5(text) AS text_md5 FROM {_RANKED} k WHERE conv_id % 5 = 1",
    "P4_content": "SELECT conv_id, turn, md5(CASE WHEN turn % 5 >= 3 THEN text || ' more' ELSE text END) AS text_md5 FROM conversations",
    "P6_timestamp": f"SELECT CAST(conv_id AS VARCHAR) AS conversation_id, r - 1 AS ordinal, 1700000000 + turn AS stamp FROM {_RANKED} k",
    "S13_profile": f"""SELECT conv_id AS file, CASE conv_id % 5 WHEN 0 THEN 'list of chat_messages' WHEN 1 THEN 'mapping' WHEN 2 THEN 'conversations' WHEN 3 THEN 'object' ELSE 'messages' END AS format, CASE WHEN conv_id % 5 = 0 THEN 'list' ELSE 'object' END AS kind,
CAST(CASE WHEN conv_id % 5 IN (1, 4) THEN 2 ELSE 1 END AS BIGINT) AS length, {_SHAPE_KEYS} AS keys FROM (SELECT DISTINCT conv_id FROM conversations) c""",
    "S14_size_estimate": "SELECT conv_id AS file, CASE WHEN conv_id % 5 = 2 THEN 1 ELSE count(*) END AS expected FROM conversations GROUP BY conv_id",
    "P2_metadata": """SELECT '{"conversation_id":"' || conv_id || '","message_id":"' || turn || '","timestamp":"' || turn * 10 || '","themes":["x"],"user_msg":{"conversation_id":"' || conv_id || '","message_id":"' || turn || '","timestamp":"' || turn * 10 || '","themes":['
 || coalesce((SELECT string_agg('"' || t || '"', ',' ORDER BY o) FROM (SELECT unnest(string_split(role, 's')) AS t, generate_subscripts(string_split(role, 's'), 1) AS o) z WHERE trim(t) <> ''), '') || ']}}' AS metadata FROM conversations""",
    "K1_document_sink": f"WITH {_PDF} SELECT {_NAME} AS filename, count(*) AS n_pages, 'ok' AS status, md5(string_agg(t, chr(10) || chr(10) ORDER BY page)) AS whole_md5, md5(string_agg(t, chr(10) || chr(10) ORDER BY page)) AS simple_md5 FROM pages GROUP BY conv_id",
    "S9_custom_source": "SELECT 'Custom text number ' || i || ' of an application' AS text, 'custom' AS source, i AS rank FROM range(100) r(i)",
    "S10_memory_store": """SELECT conv_id * 1000 + turn AS item_id, md5(text) AS text_md5, 'conversation' AS source, role AS author, CASE WHEN (conv_id * 1000 + turn) % 3 <> 0 THEN CAST(conv_id AS VARCHAR) ELSE 'unknown' END AS conversation_id,
 CASE WHEN (conv_id * 1000 + turn) % 2 <> 0 THEN CAST(turn AS VARCHAR) ELSE '0' END AS timestamp, NULL AS filename FROM conversations WHERE text <> '' AND (conv_id * 1000 + turn) % 5 <> 0
UNION ALL SELECT -doc_id - 1, md5(text), CASE WHEN doc_id % 4 <> 0 THEN 'pdf' ELSE 'unknown' END, NULL, NULL, NULL, CASE WHEN doc_id % 3 <> 0 THEN source WHEN doc_id % 4 <> 0 THEN 'unknown_pdf' END FROM documents WHERE text <> '' AND doc_id % 11 <> 0 AND doc_id % 13 <> 0""",
    "S11_jsonl_dataset": "SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE doc_id % 10 = 8",
    "K3_split_sink": f"{_PAIR_ROWS} SELECT split, conv_id, turn, md5('<|user|>' || u || '<|assistant|>' || a || '<|endoftext|>') AS text_md5, length(u || a) AS chars, len(themes) AS n_themes FROM w",
    "K5_summary": f"{_PAIR_ROWS} SELECT split, count(*) AS n, (SELECT count(*) FROM w) AS total_pairs, round(avg(score), 5) AS mean, round(stddev_pop(score), 5) AS std, round(min(score), 5) AS min, round(max(score), 5) AS max FROM w GROUP BY split",
    "S12_summary_scan": f"{_PAIR_ROWS} SELECT 'theme' AS kind, name, count(*) AS n FROM (SELECT unnest(themes) AS name FROM w) x GROUP BY name UNION ALL SELECT 'source' AS kind, 'conversation' AS name, count(*) AS n FROM w",
    "K2_memory_sink": "SELECT doc_id AS id, CAST(64 AS BIGINT) AS dim, md5(text) AS text_md5, lang, 'hashed words' AS model FROM documents",
    "K6_embed_checkpoint": "SELECT DISTINCT md5(text) AS key, CAST(64 AS BIGINT) AS dim FROM conversations",
    "K7_batch_checkpoint": r"SELECT doc_id, CASE WHEN len(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) > 0 THEN 1e0 ELSE 0e0 END AS square FROM documents",
    "K8_generations": f"SELECT 2 AS generation, kind, name, n FROM ({labels.ORACLE_SQL['G1_counts']}) g",
    "K10_vector_store": "SELECT vec_id, label FROM embeddings WHERE vec_id % 10 <> 0",
    "K11_reputation_store": f"SELECT name, n, round(s, 5) AS reward_sum, round(q, 5) AS reward_sq, round(ema, 5) AS ema_reward, last_seen, failures FROM ({_REPUTE}) z",
    "G17_reputation": f"SELECT name, n, failures, round(ema, 5) AS ema_reward, round(least(1e0, greatest(0e0, s / n + sqrt(2 * ln(n + 1) / n) * sqrt(greatest(q / n - (s / n) * (s / n), 0)))), 5) AS score FROM ({_REPUTE}) z",
    "K12_audit_log": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, event_type, CAST(user_id AS VARCHAR) AS user, 200 AS status FROM events",
    "K13_token_cache": "SELECT doc_id, CAST(least(len(regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9 ]')), 512) AS BIGINT) AS n_tokens FROM documents",
    "K14_ingest": "WITH f AS (SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 2000), n AS (SELECT * FROM f WHERE doc_id NOT IN (SELECT doc_id FROM labels)) SELECT doc_id, lang, (SELECT count(*) FROM n) AS count FROM n",
}


def _s8_oracle() -> str:
    from textloom.functions.dialect import Oracle

    return t1_windows(Oracle())


ORACLE_SQL["S8_page_documents"] = _s8_oracle()
