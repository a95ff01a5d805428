"""Labels of texts and what is learned from them: keywords, themes, counts, co-occurrence, coherence, hierarchy, information.

A text's candidates are its best TF-IDF words, or, where it has none, phrases
found by their form; normalised, the first three are its themes, and a content
type stands in where none are left. A memory sums themes over runs; here the
first run labels ``conversations`` and the second ``documents``.

The SQL of each query is written from the definitions, apart from the code
that it checks. Null texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.sources.scratch import scratch

# Words that carry no theme.
STOP_WORDS = [
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for",
    "of", "with", "by", "from", "as", "is", "was", "are", "were", "be",
    "been", "being", "have", "has", "had", "do", "does", "did", "will",
    "would", "should", "could", "may", "might", "must", "can", "shall",
]
# Fixed values: (content type, parts of a text that tell it), the first found wins. Numbers tell data_content between the third and the fourth.
CONTENT = [
    ("research_content", ["study", "research", "experiment", "hypothesis", "findings"]),
    ("structured_document", ["section", "chapter", "introduction", "conclusion", "abstract"]),
    ("visual_reference", ["figure", "table", "chart", "graph", "diagram"]),
    ("code_content", ["function", "class", "def ", "import ", "return "]),
    ("question_content", ["what", "how", "why", "when", "where"]),
]
#: Most frequent terms that are kept, and in how many texts a term must occur.
VOCABULARY, LEAST_DF = 500, 2
#: Keywords of a text, and the score that they must exceed.
KEYWORDS, LEAST_SCORE = 10, 0.1
#: Themes of a text, and their least length.
THEMES, LEAST_LENGTH = 3, 3


def stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def tokens(text: Column) -> Column:
    """Lower-cased runs of two or more letters, digits and underscores, without stop words."""
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]{2,}"), 0), lambda t: ~t.isin(STOP_WORDS))


def vocabulary(texts: DataFrame, most: int = VOCABULARY, least: int = LEAST_DF) -> DataFrame:
    """(term, df, tf, idf) of the ``most`` most frequent terms of (id, text) that occur in ``least`` texts.

    A text's tokens are sorted where it lies, so that each term's first one counts for
    df: one pass, summed in each task before anything moves.
    """
    rows = texts.select(F.array_sort(tokens(F.col("text"))).alias("t")).select(F.explode(F.transform("t", lambda x, i: F.struct(x.alias("term"), (~x.eqNullSafe(F.get("t", i - 1))).cast("long").alias("first")))).alias("x")).select("x.*")
    found = rows.groupBy("term").agg(F.sum("first").alias("df"), F.count(F.lit(1)).alias("tf")).where(F.col("df") >= least)
    n = texts.agg(F.count(F.lit(1)).alias("n"))  # one row
    top = found.orderBy(F.desc("tf"), "term").limit(most).crossJoin(F.broadcast(n))
    return top.select("term", "df", "tf", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def keywords(texts: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(id, term, score, rank): each text's best terms by unit-length TF-IDF. Only terms of the vocabulary leave a task."""
    known = F.broadcast((vocabulary(texts) if known is None else known).select("term", "idf"))  # VOCABULARY rows
    counts = texts.select("id", F.explode(tokens(F.col("text"))).alias("term")).join(known, "term").groupBy("id", "term").agg((F.count(F.lit(1)) * F.first("idf")).alias("x"))
    best = F.array_sort(F.collect_list(F.struct((-F.col("x")).alias("low"), "term")))  # at most VOCABULARY terms
    found = counts.groupBy("id").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"), best.alias("best"))
    scored = F.transform("best", lambda b: F.struct(F.round(-b["low"] / F.col("norm"), 9).alias("score"), b["term"].alias("term")))
    ranked = F.slice(F.array_sort(F.transform(scored, lambda b: F.struct((-b["score"]).alias("low"), b["term"].alias("term")))), 1, KEYWORDS)
    rows = found.select("id", F.posexplode(ranked).alias("pos", "b"))
    return rows.select("id", F.col("b.term").alias("term"), (-F.col("b.low")).alias("score"), (F.col("pos") + 1).cast("long").alias("rank")).where(F.col("score") > LEAST_SCORE)


def formed_themes(text: Column) -> Column:
    """Phrases by their form: five runs of capitalised words, three joined words, three short quotations; sorted, without repeats."""
    first = lambda pattern, group, n: F.slice(F.regexp_extract_all(text, F.lit(pattern), group), 1, n)
    capitals = first(r"(?U)\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,2}\b", 0, 5)
    joined = first(r"(?U)\b[A-Za-z]+[-_][A-Za-z0-9]+\b", 0, 3)
    quoted = first(r'"([^"]{3,30})"', 1, 3)
    return F.array_sort(F.array_distinct(F.concat(capitals, joined, quoted)))


def normalised(theme: Column) -> Column:
    """Lower-cased, words joined by underscores, without other marks and stop words; may be empty."""
    clean = F.regexp_replace(strip(F.lower(theme)), r"[^\p{L}\p{N}_\s-]", "")
    parts = F.split(F.regexp_replace(clean, r"(?U)\s+", "_"), "_")
    return F.array_join(F.filter(parts, lambda w: ~w.isin(STOP_WORDS)), "_")


def long_enough(themes: Column) -> Column:
    return F.filter(themes, lambda t: F.length(t) >= LEAST_LENGTH)


def content_type(text: Column) -> Column:
    low = F.lower(text)
    has = lambda parts: F.coalesce(*[F.when(F.contains(low, F.lit(p)), True) for p in parts], F.lit(False))
    rules = dict(CONTENT)
    numbers = F.regexp_count(text, F.lit("[0-9]+")) / F.greatest(F.size(words(text)), F.lit(1)) > 0.1
    kind = F.when(strip(text) == "", "general_content")
    for name in ("research_content", "structured_document", "visual_reference"):
        kind = kind.when(has(rules[name]), name)
    kind = kind.when(numbers, "data_content").when(has(rules["code_content"]), "code_content")
    return kind.when(strip(text).endswith("?") | has(rules["question_content"]), "question_content").otherwise("general_content")


def candidates(texts: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(id, text, phrases, words): normalised candidates, in order of rank or, where found by form, of the alphabet.

    Of those found by form, the ones with an underscore are phrases.
    """
    best = keywords(texts, known).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("best"))  # at most KEYWORDS
    rows = texts.select("id", F.coalesce("text", F.lit("")).alias("text")).join(best, "id", "left")
    none = F.array().cast("array<string>")
    formed = F.when(F.col("best").isNull(), formed_themes(F.col("text"))).otherwise(none)
    rows = rows.withColumn("formed", formed)
    joined = F.filter("formed", lambda t: F.contains(t, F.lit("_")))
    single = F.when(F.col("best").isNotNull(), F.col("best.term")).otherwise(F.filter("formed", lambda t: ~F.contains(t, F.lit("_"))))
    made = lambda c: long_enough(F.transform(c, normalised))
    return rows.select("id", "text", made(joined).alias("phrases"), made(single).alias("words"))


def labelled(found: DataFrame) -> DataFrame:
    """Candidates (id, text, phrases, words) with themes, primary_theme and confidence."""
    themes = F.slice(F.array_distinct(F.concat("phrases", "words")), 1, THEMES)
    rows = found.withColumn("themes", themes)
    rows = rows.withColumn("themes", F.when(F.size("themes") > 0, F.col("themes")).otherwise(F.array(content_type(F.col("text")))))
    return rows.select("id", "phrases", "words", "themes", F.get("themes", F.lit(0)).alias("primary_theme"), F.least(F.lit(0.8), 0.5 + 0.1 * F.size("themes")).alias("confidence"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.coalesce("text", F.lit("")).alias("text"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run, id, phrases, words, themes) of both runs, written once."""
    first = labelled(candidates(turns(spark, sf_dir))).withColumn("run", F.lit(1))
    second = labelled(candidates(documents(spark, sf_dir))).withColumn("run", F.lit(2))
    return stored(first.unionByName(second).select("run", "id", "phrases", "words", "themes"), "records")


# What a memory learns from records.


def count_names(found: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """(kind, name, n): how often each theme, phrase and word was given, with what an earlier generation had counted."""
    as_ = lambda kind, column: F.transform(column, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("name")))
    names = F.concat(as_("theme", "themes"), as_("phrase", "phrases"), as_("word", "words"))
    rows = found.select(F.explode(names).alias("x")).select("x.*", F.lit(1).cast("long").alias("n"))
    rows = rows if prior is None else rows.unionByName(prior.select("kind", "name", "n"))
    return rows.groupBy("kind", "name").agg(F.sum("n").alias("n"))


def count_pairs(found: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """(a, b, n): how often two themes were given to one text, both ways. Pairs of at most THEMES themes are made where the text lies."""
    pairs = F.flatten(F.transform("themes", lambda a: F.transform(F.filter("themes", lambda b: b != a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    rows = found.select(F.explode(pairs).alias("x")).select("x.*", F.lit(1).cast("long").alias("n"))
    rows = rows if prior is None else rows.unionByName(prior.select("a", "b", "n"))
    return rows.groupBy("a", "b").agg(F.sum("n").alias("n"))


def themes_of(names: DataFrame) -> DataFrame:
    return names.where("kind = 'theme'").select(F.col("name").alias("theme"), "n")


def coherence_weights(counts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(theme, weight): 1 + ln(1 + n) / 10, and up to 1 for partners that seldom repeat."""
    partners = pairs.groupBy(F.col("a").alias("theme")).agg(F.count(F.lit(1)).alias("partners"), F.sum("n").alias("total"))
    # least() skips nulls: themes without partners are told apart first.
    boost = F.when(F.col("partners").isNull(), 0.0).otherwise(F.least(2 * F.col("partners") / F.greatest("total", F.lit(1)), F.lit(1.0)))
    return counts.join(partners, "theme", "left").select("theme", (1 + F.log1p("n") / 10 + boost).alias("weight"))


def hierarchy(counts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(parent, child, n, child_n): a child occurs with its parent more than seven times in ten, and the parent more than twice as often."""
    child, parent = counts.select(F.col("theme").alias("child"), F.col("n").alias("child_n")), counts.select(F.col("theme").alias("parent"), F.col("n").alias("parent_n"))
    rows = pairs.select(F.col("a").alias("child"), F.col("b").alias("parent"), "n").join(child, "child").join(parent, "parent")
    return rows.where((F.col("n") / F.col("child_n") > 0.7) & (F.col("parent_n") > 2 * F.col("child_n")) & (F.col("child_n") > 0)).select("parent", "child", "n", "child_n")


def information(counts: DataFrame, pairs: DataFrame, top: int = 20) -> DataFrame:
    """(a, b, mi): the ``top`` pairs of highest pointwise information, weighted by their share."""
    total = counts.agg(F.sum("n").cast("double").alias("total"))  # one row
    rows = pairs.where("a < b").join(counts.select(F.col("theme").alias("a"), F.col("n").alias("x")), "a").join(counts.select(F.col("theme").alias("b"), F.col("n").alias("y")), "b").crossJoin(F.broadcast(total))
    share = F.col("n") / F.col("total")
    mi = share * F.log2(share / (F.col("x") / F.col("total") * (F.col("y") / F.col("total")) + 1e-10))
    return rows.select("a", "b", F.round(mi, 9).alias("mi")).orderBy(F.desc("mi"), "a", "b").limit(top)


def reinforced(found: DataFrame, counts: DataFrame, pairs: DataFrame, weights: DataFrame, mutual: DataFrame) -> DataFrame:
    """(id, theme, weight) of each candidate: its frequency and what it is known to occur with there, times its coherence, plus shared information."""
    rows = found.select("id", F.array_distinct(F.concat("phrases", "words")).alias("all"))
    rows = stored(rows.select("id", "all", F.explode("all").alias("theme")), "candidates")
    both = rows.select("id", F.col("theme").alias("a"), F.explode("all").alias("b")).where("a <> b")  # a text has at most KEYWORDS or eleven candidates
    near = both.join(pairs.select("a", "b", "n"), ["a", "b"]).groupBy("id", "a").agg(F.sum(F.least(F.col("n") / 100, F.lit(0.2))).alias("s"))
    told = mutual.select("a", "b", "mi").union(mutual.select(F.col("b"), F.col("a"), "mi"))
    told = both.join(F.broadcast(told), ["a", "b"]).groupBy("id", "a").agg(F.sum(0.3 * F.col("mi")).alias("m"))  # top pairs only
    rows = rows.drop("all").join(counts.join(weights, "theme"), "theme", "left")
    rows = rows.join(near.withColumnRenamed("a", "theme"), ["id", "theme"], "left").join(told.withColumnRenamed("a", "theme"), ["id", "theme"], "left")
    base = 1 + F.when(F.col("n").isNull(), 0.0).otherwise(F.least(F.log1p("n") / 5, F.lit(0.5))) + F.coalesce("s", F.lit(0.0))
    return rows.select("id", "theme", (base * F.coalesce("weight", F.lit(1.0)) + F.coalesce("m", F.lit(0.0))).alias("weight"))


def adaptive(found: DataFrame, counts: DataFrame, pairs: DataFrame, weights: DataFrame, mutual: DataFrame) -> DataFrame:
    """Candidates labelled by what a memory knows: themes in order of their reinforced weight; known themes and high information add confidence."""
    scored = reinforced(found, counts, pairs, weights, mutual)
    best = scored.groupBy("id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.round("weight", 9)).alias("low"), "theme"))), 1, THEMES).alias("best"))
    rows = found.join(best, "id", "left")
    rows = rows.select("id", "phrases", "words", F.coalesce(F.col("best.theme"), F.array(content_type(F.col("text")))).alias("themes"))
    rows = stored(rows, "adaptive")
    each = rows.select("id", F.explode("themes").alias("theme")).join(counts.select("theme", F.lit(1).alias("known")), "theme", "left").groupBy("id").agg(F.count("known").alias("known"))
    two = rows.select("id", F.explode(F.flatten(F.transform("themes", lambda a: F.transform(F.filter("themes", lambda b: a < b), lambda b: F.struct(a.alias("a"), b.alias("b")))))).alias("p")).select("id", "p.*")
    two = two.join(F.broadcast(mutual.select("a", "b")), ["a", "b"]).groupBy("id").agg(F.count(F.lit(1)).alias("m"))  # top pairs only
    rows = rows.join(each, "id", "left").join(two, "id", "left")
    k = F.size("themes")
    confidence = F.least(0.5 + 0.1 * k + 0.1 * F.coalesce("known", F.lit(0)) / k + 0.05 * F.least(F.coalesce("m", F.lit(0)), F.lit(3)), F.lit(0.95))
    return rows.select("id", "phrases", "words", "themes", F.get("themes", F.lit(0)).alias("primary_theme"), confidence.alias("confidence"))


def memory(found: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Counts, pairs, coherence weights and high-information pairs learned from records, each written."""
    counts = stored(themes_of(count_names(found)), "counts")
    pairs = stored(count_pairs(found), "pairs")
    return counts, pairs, stored(coherence_weights(counts, pairs), "weights"), stored(information(counts, pairs), "mutual")


# Queries.


def _known(spark, sf_dir):
    found = records(spark, sf_dir)
    return themes_of(count_names(found)), count_pairs(found)


def b1_keywords(spark, sf_dir):
    return keywords(documents(spark, sf_dir)).select(F.col("id").alias("doc_id"), "term", F.round("score", 5).alias("score"), "rank")


def l4_keywords(spark, sf_dir):
    return b1_keywords(spark, sf_dir).drop("rank")


def g25_tfidf(spark, sf_dir):
    return vocabulary(documents(spark, sf_dir)).withColumn("idf", F.round("idf", 6))


def b3_themes(spark, sf_dir):
    return documents(spark, sf_dir).select(F.col("id").alias("doc_id"), F.array_join(formed_themes(F.col("text")), "|").alias("themes"))


def b4_content(spark, sf_dir):
    return documents(spark, sf_dir).select(F.col("id").alias("doc_id"), content_type(F.col("text")).alias("kind"))


def b5_normaliser(spark, sf_dir):
    """Each theme found by form, normalised; null where nothing is left."""
    rows = documents(spark, sf_dir).select(F.col("id").alias("doc_id"), F.explode(formed_themes(F.col("text"))).alias("raw"))
    return rows.select("doc_id", "raw", F.nullif(normalised(F.col("raw")), F.lit("")).alias("theme"))


def b6_candidates(spark, sf_dir):
    return candidates(documents(spark, sf_dir)).select(F.col("id").alias("doc_id"), F.array_join("phrases", "|").alias("phrases"), F.array_join("words", "|").alias("words"))


def b7_label(spark, sf_dir):
    found = labelled(candidates(documents(spark, sf_dir)))
    return found.select(F.col("id").alias("doc_id"), F.array_join("themes", "|").alias("themes"), "primary_theme", F.round("confidence", 6).alias("confidence"))


def f17_themes(spark, sf_dir):
    """Themes found by form, normalised, of three characters or more."""
    made = F.array_sort(F.array_distinct(long_enough(F.transform(formed_themes(F.col("text")), normalised))))
    return documents(spark, sf_dir).select(F.col("id").alias("doc_id"), F.array_join(made, "|").alias("themes"))


def b8_adaptive(spark, sf_dir):
    """Documents labelled by a memory that has learned from conversations."""
    known = memory(stored(labelled(candidates(turns(spark, sf_dir))), "first"))
    found = adaptive(stored(candidates(documents(spark, sf_dir)), "second"), *known)
    return found.select(F.col("id").alias("doc_id"), F.array_join("themes", "|").alias("themes"), "primary_theme", F.round("confidence", 6).alias("confidence"))


def q_reinforced(spark, sf_dir):
    known = memory(stored(labelled(candidates(turns(spark, sf_dir))), "first"))
    found = reinforced(stored(candidates(documents(spark, sf_dir)), "second"), *known)
    return found.select(F.col("id").alias("doc_id"), "theme", F.round("weight", 5).alias("weight"))


def g1_counts(spark, sf_dir):
    """Names counted in documents, on top of what the generation before counted in conversations."""
    prior = count_names(labelled(candidates(turns(spark, sf_dir))))
    return count_names(labelled(candidates(documents(spark, sf_dir))), prior)


def g2_pairs(spark, sf_dir):
    return count_pairs(records(spark, sf_dir))


def g3_coherence(spark, sf_dir):
    return coherence_weights(*_known(spark, sf_dir)).withColumn("weight", F.round("weight", 6))


def g6_hierarchy(spark, sf_dir):
    return hierarchy(*_known(spark, sf_dir)).select("parent", "child")


def g7_information(spark, sf_dir):
    return information(*_known(spark, sf_dir)).withColumn("mi", F.round("mi", 6))


def j12_pairs(spark, sf_dir):
    found = labelled(candidates(documents(spark, sf_dir)))
    pairs = F.flatten(F.transform("themes", lambda a: F.transform(F.filter("themes", lambda b: b != a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return found.select(F.col("id").alias("doc_id"), F.explode(pairs).alias("p")).select("doc_id", "p.*")


def inverse_weights(counts: DataFrame) -> DataFrame:
    """(theme, weight): one over the share of all themes plus a hundredth."""
    total = counts.agg(F.sum("n").alias("total"))  # one row
    return counts.crossJoin(F.broadcast(total)).select("theme", (1 / (F.col("n") / F.col("total") + 0.01)).alias("weight"))


def j7_weights(spark, sf_dir):
    """Mean weight of a document's themes, by the shares that conversations have; themes unknown there weigh 1."""
    weights = inverse_weights(themes_of(count_names(labelled(candidates(turns(spark, sf_dir))))))
    rows = labelled(candidates(documents(spark, sf_dir))).select("id", F.explode("themes").alias("theme")).join(weights, "theme", "left")
    return rows.groupBy(F.col("id").alias("doc_id")).agg(F.round(F.avg(F.coalesce("weight", F.lit(1.0))), 5).alias("weight"))


def sample_themes(themes: Column, semantic: Column, primary: Column, nested: Column) -> Column:
    """The first that is not empty of themes, semantic themes, the primary theme, those of the messages; general content else."""
    full = lambda a: F.when(F.size(a) > 0, a)
    return F.coalesce(full(themes), full(semantic), F.when(primary != "", F.array(primary)), full(nested), F.array(F.lit("general_content")))


def a8_weights(spark, sf_dir):
    """Sample weights: themes as words, as phrases, the primary theme where it is no content type, by the shares in all documents."""
    found = stored(labelled(candidates(documents(spark, sf_dir))), "a8")
    plain = F.col("primary_theme").endswith("_content") | (F.col("primary_theme") == "structured_document") | (F.col("primary_theme") == "visual_reference")
    nested = F.when(plain, F.array("primary_theme")).otherwise(F.array().cast("array<string>"))
    rows = found.select("id", sample_themes(F.slice("words", 1, THEMES), F.slice("phrases", 1, THEMES), F.when(~plain, F.col("primary_theme")), nested).alias("themes"))
    weights = inverse_weights(themes_of(count_names(found)))
    rows = rows.select("id", F.explode("themes").alias("theme")).join(weights, "theme", "left")
    return rows.groupBy(F.col("id").alias("doc_id")).agg(F.round(F.avg(F.coalesce("weight", F.lit(1.0))), 5).alias("weight"))


def g10_distribution(spark, sf_dir):
    """Theme counts of pairs: of a document's words, ``general`` where it has none."""
    found = labelled(candidates(documents(spark, sf_dir)))
    themes = F.when(F.size("words") > 0, F.slice("words", 1, THEMES))
    return found.select(F.explode(F.coalesce(themes, F.array(F.lit("general")))).alias("theme")).groupBy("theme").agg(F.count(F.lit(1)).alias("n"))


def g13_top(spark, sf_dir):
    counts = themes_of(count_names(labelled(candidates(documents(spark, sf_dir)))))
    return counts.orderBy(F.desc("n"), "theme").limit(20)


def diversity(seen: DataFrame, known: DataFrame) -> DataFrame:
    """One row: entropy in bits, share of the known themes that were seen, number of themes and of their occurrences."""
    total = seen.agg(F.sum("n").alias("total"))  # one row
    share = F.col("n") / F.col("total")
    found = seen.crossJoin(F.broadcast(total)).agg(F.coalesce(-F.sum(share * F.log2(share)), F.lit(0.0)).alias("entropy"), F.count(F.lit(1)).alias("uniques"), F.coalesce(F.sum("n"), F.lit(0)).alias("occurrences"))
    all_ = known.agg(F.count(F.lit(1)).alias("known"))
    return found.crossJoin(all_).select(F.round("entropy", 6).alias("entropy"), F.round(F.col("uniques") / F.greatest("known", F.lit(1)), 6).alias("coverage"), "uniques", "occurrences")


def g14_entropy(spark, sf_dir):
    """Themes that documents show, of all that both runs know."""
    found = records(spark, sf_dir)
    return diversity(themes_of(count_names(found.where("run = 2"))), themes_of(count_names(found)))


def g15_weights(spark, sf_dir):
    return inverse_weights(themes_of(count_names(labelled(candidates(documents(spark, sf_dir)))))).withColumn("weight", F.round("weight", 6))


QUERIES = {
    "B1_tfidf_keywords": b1_keywords, "L4_keywords": l4_keywords, "G25_tfidf": g25_tfidf, "B3_heuristic_themes": b3_themes, "B4_content_type": b4_content, "B5_theme_normaliser": b5_normaliser, "B6_candidates": b6_candidates,
    "B7_label": b7_label, "F17_theme_filter": f17_themes, "B8_adaptive_label": b8_adaptive, "Q_reinforced": q_reinforced, "G1_counts": g1_counts, "G2_cooccurrence": g2_pairs, "G3_coherence": g3_coherence, "G6_hierarchy": g6_hierarchy,
    "G7_mutual_information": g7_information, "J12_theme_pairs": j12_pairs, "J7_theme_weights": j7_weights, "A8_sample_weight": a8_weights, "G10_theme_distribution": g10_distribution, "G13_top_themes": g13_top, "G14_entropy": g14_entropy, "G15_inverse_weights": g15_weights,
}

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_HAS = {k: " OR ".join(f"contains(lower(text), '{p}')" for p in parts) for k, parts in CONTENT}
_STRIPPED = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"
_KIND = f"""CASE WHEN {_STRIPPED} = '' THEN 'general_content' WHEN {_HAS['research_content']} THEN 'research_content' WHEN {_HAS['structured_document']} THEN 'structured_document' WHEN {_HAS['visual_reference']} THEN 'visual_reference'
  WHEN len(regexp_extract_all(text, '[0-9]+')) / greatest(len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')), 1) > 0.1 THEN 'data_content'
  WHEN {_HAS['code_content']} THEN 'code_content' WHEN ends_with({_STRIPPED}, '?') OR {_HAS['question_content']} THEN 'question_content' ELSE 'general_content' END"""
# Word borders of this dialect know ASCII only: letters beyond it become two underscores, which no pattern takes for a border or a part of a match.
_ASCII = r"regexp_replace(text, '[^\x00-\x7F\p{P}\p{S}\p{Z}]', '__', 'g')"
_FORMED = rf"""list_sort(list_distinct(list_concat(list_concat(regexp_extract_all({_ASCII}, '\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+){{0,2}}\b')[1:5],
  regexp_extract_all({_ASCII}, '\b[A-Za-z]+[-_][A-Za-z0-9]+\b')[1:3]), regexp_extract_all(text, '"([^"]{{3,30}})"', 1)[1:3])))"""


def _norm(x: str) -> str:
    return rf"array_to_string(list_filter(string_split(regexp_replace(regexp_replace(regexp_replace(lower({x}), '^\s+|\s+$', '', 'g'), '[^\p{{L}}\p{{N}}_\s-]', '', 'g'), '\s+', '_', 'g'), '_'), lambda w: NOT list_contains([{_STOP}], w)), '_')"


def _chain(p: str, source: str, key: str) -> str:
    """Common tables of a run: p_src, p_voc, p_kw (ranked keywords), p_cand (phrases, words), p_lab (themes, kind)."""
    return rf"""{p}_src AS (SELECT {key} AS id, coalesce(text, '') AS text FROM {source}),
{p}_cnt AS (SELECT id, term, count(*) AS n FROM (SELECT id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM {p}_src) t WHERE term NOT IN ({_STOP}) GROUP BY id, term),
{p}_voc AS (SELECT term, count(*) AS df, CAST(sum(n) AS BIGINT) AS tf, ln((1e0 + (SELECT count(*) FROM {p}_src)) / (1e0 + count(*))) + 1e0 AS idf FROM {p}_cnt GROUP BY term HAVING count(*) >= 2 ORDER BY sum(n) DESC, term LIMIT 500),
{p}_sc AS (SELECT c.id, c.term, round(c.n * v.idf / sqrt(sum(c.n * v.idf * c.n * v.idf) OVER (PARTITION BY c.id)), 9) AS score FROM {p}_cnt c JOIN {p}_voc v ON c.term = v.term),
{p}_kw AS (SELECT * FROM (SELECT id, term, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, term) AS rank FROM {p}_sc) s WHERE rank <= 10 AND score > 0.1),
{p}_top AS (SELECT id, list(term ORDER BY rank) AS best FROM {p}_kw GROUP BY id),
{p}_form AS (SELECT s.id, s.text, t.best, CASE WHEN t.best IS NULL THEN {_FORMED.replace('text', 's.text')} ELSE [] END AS formed FROM {p}_src s LEFT JOIN {p}_top t ON s.id = t.id),
{p}_cand AS (SELECT id, text, list_filter(list_transform(list_filter(formed, lambda x: contains(x, '_')), lambda x: {_norm('x')}), lambda y: length(y) >= 3) AS phrases,
  list_filter(list_transform(coalesce(best, list_filter(formed, lambda x: NOT contains(x, '_'))), lambda x: {_norm('x')}), lambda y: length(y) >= 3) AS words FROM {p}_form),
{p}_all AS (SELECT *, list_concat(phrases, words) AS both_ FROM {p}_cand),
{p}_uniq AS (SELECT *, list_filter(both_, lambda x, i: list_position(both_, x) = i) AS every FROM {p}_all),
{p}_lab AS (SELECT id, text, phrases, words, every, CASE WHEN len(every) > 0 THEN every[1:3] ELSE [{_KIND}] END AS themes FROM {p}_uniq)"""


_DOCS, _CONV = _chain("d", "documents", "doc_id"), _chain("c", "conversations", "conv_id * 1000 + turn")
_EACH = "ex AS (SELECT 1 AS run, id, unnest(themes) AS theme FROM c_lab UNION ALL SELECT 2 AS run, id, unnest(themes) AS theme FROM d_lab)"
_BOTH = f"""WITH {_CONV}, {_DOCS}, {_EACH},
counts AS (SELECT theme, count(*) AS n FROM ex GROUP BY theme),
pairs AS (SELECT x.theme AS a, y.theme AS b, count(*) AS n FROM ex x JOIN ex y ON x.run = y.run AND x.id = y.id AND x.theme <> y.theme GROUP BY x.theme, y.theme)"""
_FIRST = f"""WITH {_CONV}, {_DOCS}, ex AS (SELECT id, unnest(themes) AS theme FROM c_lab),
counts AS (SELECT theme, count(*) AS n FROM ex GROUP BY theme),
pairs AS (SELECT x.theme AS a, y.theme AS b, count(*) AS n FROM ex x JOIN ex y ON x.id = y.id AND x.theme <> y.theme GROUP BY x.theme, y.theme)"""
_WEIGHTS = "weights AS (SELECT c.theme, 1 + ln(1 + c.n) / 10 + CASE WHEN p.k IS NULL THEN 0 ELSE least(2e0 * p.k / greatest(p.t, 1), 1e0) END AS weight FROM counts c LEFT JOIN (SELECT a, count(*) AS k, sum(n) AS t FROM pairs GROUP BY a) p ON c.theme = p.a)"
_MUTUAL = """mutual AS (SELECT p.a, p.b, round((p.n / t.t) * log2((p.n / t.t) / ((x.n / t.t) * (y.n / t.t) + 1e-10)), 9) AS mi FROM pairs p JOIN counts x ON p.a = x.theme JOIN counts y ON p.b = y.theme
  CROSS JOIN (SELECT CAST(sum(n) AS DOUBLE) AS t FROM counts) t WHERE p.a < p.b ORDER BY mi DESC, p.a, p.b LIMIT 20)"""
_REINFORCED = f"""{_WEIGHTS}, {_MUTUAL}, cand AS (SELECT id, unnest(every) AS theme FROM d_uniq),
near AS (SELECT x.id, x.theme, sum(least(p.n / 100e0, 0.2e0)) AS s FROM cand x JOIN cand y ON x.id = y.id AND x.theme <> y.theme JOIN pairs p ON p.a = x.theme AND p.b = y.theme GROUP BY x.id, x.theme),
told AS (SELECT x.id, x.theme, sum(0.3e0 * m.mi) AS m FROM cand x JOIN cand y ON x.id = y.id JOIN mutual m ON (m.a = x.theme AND m.b = y.theme) OR (m.b = x.theme AND m.a = y.theme) GROUP BY x.id, x.theme),
force AS (SELECT k.id, k.theme, (1 + CASE WHEN c.n IS NULL THEN 0 ELSE least(ln(1 + c.n) / 5, 0.5e0) END + coalesce(n.s, 0)) * coalesce(w.weight, 1) + coalesce(t.m, 0) AS weight FROM cand k LEFT JOIN counts c ON k.theme = c.theme LEFT JOIN weights w ON k.theme = w.theme
  LEFT JOIN near n ON n.id = k.id AND n.theme = k.theme LEFT JOIN told t ON t.id = k.id AND t.theme = k.theme)"""
_DWEIGHTS = "dw AS (SELECT theme, 1 / (n / sum(n) OVER () + 0.01e0) AS weight FROM (SELECT theme, count(*) AS n FROM (SELECT unnest(themes) AS theme FROM d_lab) u GROUP BY theme) v)"

ORACLE_SQL = {
    "B1_tfidf_keywords": f"WITH {_DOCS} SELECT id AS doc_id, term, round(score, 5) AS score, rank FROM d_kw",
    "L4_keywords": f"WITH {_DOCS} SELECT id AS doc_id, term, round(score, 5) AS score FROM d_kw",
    "G25_tfidf": f"WITH {_DOCS} SELECT term, df, tf, round(idf, 6) AS idf FROM d_voc",
    "B3_heuristic_themes": f"SELECT doc_id, array_to_string({_FORMED}, '|') AS themes FROM documents",
    "B4_content_type": f"SELECT doc_id, {_KIND} AS kind FROM documents",
    "B5_theme_normaliser": f"SELECT doc_id, raw, nullif({_norm('raw')}, '') AS theme FROM (SELECT doc_id, unnest({_FORMED}) AS raw FROM documents) f",
    "B6_candidates": f"WITH {_DOCS} SELECT id AS doc_id, array_to_string(phrases, '|') AS phrases, array_to_string(words, '|') AS words FROM d_cand",
    "B7_label": f"WITH {_DOCS} SELECT id AS doc_id, array_to_string(themes, '|') AS themes, themes[1] AS primary_theme, round(least(0.8e0, 0.5e0 + 0.1e0 * len(themes)), 6) AS confidence FROM d_lab",
    "F17_theme_filter": f"SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(f, lambda x: {_norm('x')}), lambda y: length(y) >= 3))), '|') AS themes FROM (SELECT doc_id, {_FORMED} AS f FROM documents) s",
    "B8_adaptive_label": f"""{_FIRST}, {_REINFORCED},
ranked AS (SELECT id, theme, row_number() OVER (PARTITION BY id ORDER BY round(weight, 9) DESC, theme) AS r FROM force),
best AS (SELECT id, list(theme ORDER BY r) AS best FROM ranked WHERE r <= 3 GROUP BY id),
lab AS (SELECT d.id, CASE WHEN b.best IS NOT NULL THEN b.best ELSE [{_KIND.replace('text', 'd.text')}] END AS themes FROM d_src d LEFT JOIN best b ON d.id = b.id),
one AS (SELECT id, unnest(themes) AS theme FROM lab),
kn AS (SELECT o.id, count(*) AS known FROM one o JOIN counts c ON o.theme = c.theme GROUP BY o.id),
mu AS (SELECT x.id, count(*) AS m FROM one x JOIN one y ON x.id = y.id JOIN mutual m ON m.a = x.theme AND m.b = y.theme GROUP BY x.id)
SELECT l.id AS doc_id, array_to_string(l.themes, '|') AS themes, l.themes[1] AS primary_theme, round(least(0.5e0 + 0.1e0 * len(l.themes) + 0.1e0 * coalesce(k.known, 0) / len(l.themes) + 0.05e0 * least(coalesce(m.m, 0), 3), 0.95e0), 6) AS confidence
FROM lab l LEFT JOIN kn k ON l.id = k.id LEFT JOIN mu m ON l.id = m.id""",
    "Q_reinforced": f"{_FIRST}, {_REINFORCED} SELECT id AS doc_id, theme, round(weight, 5) AS weight FROM force",
    "G1_counts": f"""WITH {_CONV}, {_DOCS}, lab AS (SELECT phrases, words, themes FROM c_lab UNION ALL SELECT phrases, words, themes FROM d_lab)
SELECT kind, name, count(*) AS n FROM (SELECT 'theme' AS kind, unnest(themes) AS name FROM lab UNION ALL SELECT 'phrase' AS kind, unnest(phrases) AS name FROM lab UNION ALL SELECT 'word' AS kind, unnest(words) AS name FROM lab) x GROUP BY kind, name""",
    "G2_cooccurrence": f"{_BOTH} SELECT a, b, n FROM pairs",
    "G3_coherence": f"{_BOTH}, {_WEIGHTS} SELECT theme, round(weight, 6) AS weight FROM weights",
    "G6_hierarchy": f"{_BOTH} SELECT p.b AS parent, p.a AS child FROM pairs p JOIN counts c ON p.a = c.theme JOIN counts q ON p.b = q.theme WHERE p.n / c.n > 0.7 AND q.n > c.n * 2",
    "G7_mutual_information": f"{_BOTH}, {_MUTUAL} SELECT a, b, round(mi, 6) AS mi FROM mutual",
    "J12_theme_pairs": f"WITH {_DOCS}, ex AS (SELECT id, unnest(themes) AS theme FROM d_lab) SELECT x.id AS doc_id, x.theme AS a, y.theme AS b FROM ex x JOIN ex y ON x.id = y.id AND x.theme <> y.theme",
    "J7_theme_weights": f"""WITH {_CONV}, {_DOCS}, w AS (SELECT theme, 1 / (n / sum(n) OVER () + 0.01e0) AS weight FROM (SELECT theme, count(*) AS n FROM (SELECT unnest(themes) AS theme FROM c_lab) u GROUP BY theme) v)
SELECT e.id AS doc_id, round(avg(coalesce(w.weight, 1)), 5) AS weight FROM (SELECT id, unnest(themes) AS theme FROM d_lab) e LEFT JOIN w ON e.theme = w.theme GROUP BY e.id""",
    "A8_sample_weight": f"""WITH {_DOCS}, {_DWEIGHTS}, pick AS (SELECT id, CASE WHEN len(words) > 0 THEN words[1:3] WHEN len(phrases) > 0 THEN phrases[1:3] ELSE themes END AS themes FROM d_lab)
SELECT e.id AS doc_id, round(avg(coalesce(w.weight, 1)), 5) AS weight FROM (SELECT id, unnest(themes) AS theme FROM pick) e LEFT JOIN dw w ON e.theme = w.theme GROUP BY e.id""",
    "G10_theme_distribution": f"WITH {_DOCS} SELECT theme, count(*) AS n FROM (SELECT unnest(CASE WHEN len(words) > 0 THEN words[1:3] ELSE ['general'] END) AS theme FROM d_lab) x GROUP BY theme",
    "G13_top_themes": f"WITH {_DOCS} SELECT theme, count(*) AS n FROM (SELECT unnest(themes) AS theme FROM d_lab) x GROUP BY theme ORDER BY n DESC, theme LIMIT 20",
    "G14_entropy": f"""{_BOTH}, seen AS (SELECT theme, count(*) AS n FROM ex WHERE run = 2 GROUP BY theme)
SELECT round(-sum(n / t * log2(n / t)), 6) AS entropy, round(count(*) / (SELECT count(*) FROM counts), 6) AS coverage, count(*) AS uniques, CAST(sum(n) AS BIGINT) AS occurrences FROM seen CROSS JOIN (SELECT sum(n) AS t FROM seen) s""",
    "G15_inverse_weights": f"WITH {_DOCS}, {_DWEIGHTS} SELECT theme, round(weight, 6) AS weight FROM dw",
}
