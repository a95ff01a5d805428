"""Turns of conversations: predicates, plans, prompts, pairs of questions and answers, and their scores with similarity.

The SQL of each query is written from the definitions, apart from the code that
it checks. Null texts count as empty, null roles as none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.dialect import Spark
from textloom.functions.embedding import Embedder, coherence_column, similarity_column
from textloom.operators import labels
from textloom.operators.labels import _CONV, _DOCS, strip, words
from textloom.operators.text import curated, doubles, measured, parts

# Words that ask for retrieval, for memory of the conversation, and for a creative answer.
RECALL = ["remember", "earlier", "before", "you said", "we talked", "you mentioned", "last time", "previously", "recall", "what did", "did you", "have we"]
MEMORY = ["remember", "earlier", "before", "you said"]
CREATIVE = ["why", "how", "explain", "analyze", "compare", "what if"]
#: Families whose answers carry reasoning; those that take the system text as instructions.
THINKING, INSTRUCTED = ("deepseek",), ("phi",)
FAMILIES = ("gemma", "llama", "mistral", "qwen", "deepseek", "phi", "chatml")
NO_REASONING = "IMPORTANT: Do NOT use <think> tags or show internal reasoning. Respond directly and concisely."
# Fixed values: (before the user's text, after it, what opens the answer) where a family has no template of its own at hand.
MARKS = {
    "gemma": ("<start_of_turn>user\n", "<end_of_turn>\n", "<start_of_turn>model\n"),
    "llama": ("<|start_header_id|>user<|end_header_id|>\n\n", "<|eot_id|>", "<|start_header_id|>assistant<|end_header_id|>\n\n"),
    "mistral": ("", " [/INST]", ""),
    "phi": ("<|user|>\n", "<|end|>\n", "<|assistant|>\n"),
}
CHATML = ("<|im_start|>user\n", "<|im_end|>\n", "<|im_start|>assistant\n")
# Questions on a passage; {first} is its first paragraph, {theme} its theme, {term} one of its capitalised terms.
TEMPLATES = [
    "Summarize the key ideas in: '{first}'.",
    "What is the main topic in this text: '{first}'?",
    "What key arguments are made in this text?",
    "What questions does this passage raise?",
    "Describe the key steps in: '{first}'.",
    "What are the implications discussed regarding {theme}?",
    "What examples are provided in: '{first}'?",
    "How does this relate to {theme}?",
    "Explain the significance of '{term}' in this passage.",
    "What does the text say about '{term}'?",
]
PAIR_GATE, CHUNK_GATE, PER_SOURCE = 0.46, 0.4, 5000 // 3


def _read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def any_of(text: Column, parts_: list[str]) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    found = F.lit(False)
    for p in parts_:
        found = found | F.contains(low, F.lit(p))
    return found


def flag(x: Column) -> Column:
    return F.when(x, 1).otherwise(0)


def needs_retrieval(text: Column) -> Column:
    return any_of(text, RECALL) | (F.size(words(text)) >= 5)


def plan_of(text: Column) -> Column:
    """What a prompt asks for: retrieval, a summary, both or nothing (null)."""
    retrieve, summarise = any_of(text, ["retrieve", "find"]), (F.length(text) > 100) | any_of(text, ["summarize"])
    return F.when(retrieve & summarise, F.array(F.lit("RETRIEVE"), F.lit("SUMMARIZE"))).when(retrieve, F.array(F.lit("RETRIEVE"))).when(summarise, F.array(F.lit("SUMMARIZE")))


def generation_config(text: Column, family: str = "chatml") -> Column:
    """0 balanced, 1 creative, 2 focused."""
    if family == "phi":
        return F.lit(2)
    return F.when(any_of(text, CREATIVE), 1).when(F.size(words(text)) < 5, 2).otherwise(0)


def format_prompt(user: Column, family: str, system: Column | None = None, context: Column | None = None, show_reasoning: bool = True) -> Column:
    """A prompt in the marks of a chat family; system text and context stand in front of the user's text. Null or empty ones are left out."""
    system = F.coalesce(F.lit("").cast("string") if system is None else system, F.lit(""))
    if not show_reasoning and family in THINKING:
        system = F.when(system != "", F.concat(system, F.lit("\n\n" + NO_REASONING))).otherwise(F.lit(NO_REASONING))
    context = F.coalesce(F.lit("").cast("string") if context is None else context, F.lit(""))
    front = F.concat(F.lit("Instructions: "), system, F.lit("\n\nQuestion: ")) if family in INSTRUCTED else F.concat(F.lit("[System: "), system, F.lit("]\n\n"))
    body = F.concat(F.when(system != "", front).otherwise(""), F.when(context != "", F.concat(F.lit("[Context from memory:\n"), context, F.lit("]\n\n"))).otherwise(""), F.coalesce(user, F.lit("")))
    before, after, answer = MARKS.get(family, CHATML)
    return F.concat(F.lit(before), body, F.lit(after + answer))


def paired(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, user_turn, user, assistant): answers that follow a user's turn at once; empty turns do not count."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = turns.where(strip(F.coalesce("text", F.lit(""))) != "").withColumns({"prev_role": F.lag("role").over(w), "user": F.lag("text").over(w), "user_turn": F.lag("turn").over(w)})
    return rows.where("role = 'assistant' AND prev_role = 'user'").select("conv_id", "turn", "user_turn", strip(F.col("user")).alias("user"), strip(F.col("text")).alias("assistant"))


def rolling_context(turns: DataFrame, size: int = 3) -> DataFrame:
    """(conv_id, turn, context) of the user's turns: the last ``size`` (at most four) lines of earlier pairs, marked by who speaks."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    pairs = paired(turns)
    lines = lambda u, a: F.array(F.concat(F.lit("User: "), u), F.concat(F.lit("Assistant: "), a))
    pairs = pairs.withColumn("lines", lines(F.col("user"), F.col("assistant")))
    pairs = pairs.select("conv_id", "turn", F.concat(F.coalesce(F.lag("lines").over(w), F.array().cast("array<string>")), "lines").alias("lines"))
    rows = turns.where(strip(F.coalesce("text", F.lit(""))) != "").join(pairs, ["conv_id", "turn"], "left")
    last = F.last("lines", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("last", F.coalesce(last, F.array().cast("array<string>"))).where("role = 'user'")
    return rows.select("conv_id", "turn", F.array_join(F.slice("last", F.greatest(F.size("last") - (size - 1), F.lit(1)), size), " ").alias("context"))


def assess(pairs: DataFrame, user: str, assistant: str, embedder: Embedder | None = None) -> DataFrame:
    """Adds what pairs are judged by, and ``score``: 1, less for odd length ratios and similarities, long sentences and repeated words."""
    u, a = F.col(user), F.col(assistant)
    n_words, low = F.size(words(a)), words(F.lower(a))
    rows = pairs.withColumns({
        "user_len": F.length(u).cast("long"), "assistant_len": F.length(a).cast("long"), "user_words": F.size(words(u)).cast("long"), "assistant_words": n_words.cast("long"),
        "similarity": F.round(similarity_column(u, a, embedder), 9), "ratio": F.when(F.length(u) > 0, F.length(a) / F.length(u)).otherwise(0.0),
        "readability": F.least(F.lit(1.0), 20 / F.greatest(n_words / F.size(F.split(a, "[.!?]+")), F.lit(1.0))), "density": F.size(F.array_distinct(low)) / F.greatest(F.size(low), F.lit(1)),
    })
    score = F.when(F.col("ratio").between(0.1, 10), 1.0).otherwise(0.5) * F.when(F.col("similarity").between(0.1, 0.95), 1.0).otherwise(0.7)
    return rows.withColumn("score", score * (0.7 + 0.3 * F.col("readability")) * (0.8 + 0.2 * F.col("density")))


ROUNDED = ["similarity", "ratio", "readability", "density", "score"]


def conversational_pairs(turns: DataFrame, known: DataFrame, gate: float = PAIR_GATE, embedder: Embedder | None = None) -> DataFrame:
    """Pairs of ``gate`` or more with their text for training and the answer's themes. known: (id, themes) by conv_id * 1000 + turn."""
    rows = assess(paired(turns), "user", "assistant", embedder).where(F.round("score", 9) >= gate)
    text = F.concat(F.lit("<|user|>"), "user", F.lit("<|assistant|>"), "assistant", F.lit("<|endoftext|>"))
    return rows.withColumn("text", text).withColumn("id", F.col("conv_id") * 1000 + F.col("turn")).join(known.select("id", "themes"), "id", "left")


def smart_truncate(text: Column, most: int = 500) -> Column:
    """At most ``most`` characters: up to the last sentence end, else the last blank."""
    cut = F.substring(text, 1, most)
    last = lambda p: F.when(F.contains(cut, F.lit(p)), most - F.instr(F.reverse(cut), p[::-1]) - len(p) + 2).otherwise(0)
    end = F.greatest(last(". "), last("? "), last("! "))
    space = last(" ")
    return F.when(F.length(text) <= most, text).when(end > 0, F.substring(text, F.lit(1), end)).when(space > 0, F.substring(text, F.lit(1), space - 1)).otherwise(cut)


def prompts(texts: DataFrame, k: int = 4, seed: int = 42) -> DataFrame:
    """(id, question): ``k`` of the templates, drawn by a hash of id and template; rows (id, text, theme).

    The term is the capitalised one or two words of the text whose hash is smallest; without any, two templates fall away.
    """
    paragraph = smart_truncate(strip(F.get(F.split("text", "\n\n+"), F.lit(0))))
    terms = F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?U)\b[A-Z][a-z]+(?:\s[A-Z][a-z]+)?\b"), 0))
    draw = lambda x: F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"), F.lit(":"), x))
    term = F.array_min(F.transform(terms, lambda t: F.struct(draw(t).alias("h"), t.alias("t"))))["t"]
    rows = texts.select("id", paragraph.alias("first"), "theme", term.alias("term"))

    def filled(template: str) -> Column:
        out = F.lit(template)
        for name in ("first", "theme", "term"):
            if "{" + name + "}" in template:
                before, after = template.split("{" + name + "}")
                out = F.concat(F.lit(before), F.col(name), F.lit(after))
        return out

    made = F.array(*[F.struct(draw(F.lit(str(i))).alias("h"), F.lit(i).alias("k"), filled(t).alias("question")) for i, t in enumerate(TEMPLATES)])
    drawn = F.slice(F.array_sort(F.filter(made, lambda x: x["question"].isNotNull())), 1, k)
    return rows.select("id", F.explode(drawn).alias("x")).select("id", F.col("x.question").alias("question"))


def answer_of(text: Column, most: int = 200) -> Column:
    """The first ``most`` words, up to the last sentence end if that lies beyond seven tenths, else marked as cut; texts of at most so many words as they are."""
    w = words(text)
    cut = F.array_join(F.slice(w, 1, most), " ")
    last = lambda p: F.when(F.contains(cut, F.lit(p)), F.length(cut) - F.instr(F.reverse(cut), p[::-1])).otherwise(0)
    end = F.greatest(last(". "), last("? "), last("! "))
    return F.when(F.size(w) <= most, text).when(end - 1 > F.length(cut) * 0.7, F.substring(cut, F.lit(1), end)).otherwise(F.concat(cut, F.lit("...")))


def composite_quality(spark, sf_dir: str, embedder: Embedder | None = None) -> DataFrame:
    """(doc_id, text, quality, coherence): the weighted mean of all six scores."""
    _read(spark, sf_dir, "documents").createOrReplaceTempView("documents")
    p = parts(Spark())
    rows = spark.sql(f"SELECT doc_id, text, {', '.join(f'{v} AS {k}' for k, v in p.items())} FROM {measured(Spark())} m")
    rows = rows.withColumn("coherence", F.round(coherence_column(F.col("text"), embedder), 9))
    total = 0.10 * F.col("len_q") + 0.20 * F.col("coh_q") + 0.20 * F.col("inf_q") + 0.15 * F.col("str_q") + 0.15 * F.col("lin_q") + 0.20 * F.col("coherence")
    return rows.select("doc_id", "text", "coherence", F.round(total + 1e-9, 3).alias("quality"))


# Queries.


def _turns(spark, sf_dir):
    return _read(spark, sf_dir, "conversations")


def f10_retrieval(spark, sf_dir):
    return _turns(spark, sf_dir).select("conv_id", "turn", flag(needs_retrieval(F.col("text"))).alias("wanted"))


def f11_memory(spark, sf_dir):
    return _turns(spark, sf_dir).select("conv_id", "turn", flag(any_of(F.col("text"), MEMORY)).alias("wanted"))


def f14_experts(spark, sf_dir):
    """What the experts of a prompt propose; rehearsal is of good documents' opposites, the documents named by the conversation's number."""
    t = F.col("text")
    gold = _read(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("conv_id")).agg((F.max("quality") == 1).alias("gold"))
    rows = _turns(spark, sf_dir).join(gold, "conv_id", "left")
    plan = F.array_join(plan_of(t), ",")
    return rows.select(
        "conv_id", "turn", flag(any_of(t, ["retrieve", "find"])).alias("retrieve"), flag((F.length(t) > 100) | any_of(t, ["summarize"])).alias("summarise"),
        flag(any_of(t, ["rehearse"]) & F.col("gold").isNotNull() & ~F.coalesce("gold", F.lit(False))).alias("rehearse"), F.when(F.length(t) > 100, "System-2").otherwise("System-1").alias("mode"), plan.alias("plan"),
    )


def f15_router(spark, sf_dir):
    """Events as proposals: those that a user's plan (the types of the first two events) or the setting of plans asks for; all where none is."""
    events = _read(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    w = Window.partitionBy("user_id").orderBy("event_id")
    first = events.withColumn("r", F.row_number().over(w)).where("r <= 2 AND event_type <> 'view'").groupBy("user_id").agg(F.collect_set("event_type").alias("plan"))
    rows = events.join(first, "user_id", "left")
    ok = F.coalesce(F.array_contains("plan", F.col("event_type")), F.lit(False)) | F.col("event_type").isin("SET_PLAN", "SET_MODE")
    rows = rows.withColumn("ok", ok).withColumn("any", F.max(flag(F.col("ok"))).over(Window.partitionBy("user_id")))
    return rows.where("plan IS NULL OR ok OR any = 0").select("event_id")


def f16_config(spark, sf_dir):
    t = F.col("text")
    return _turns(spark, sf_dir).select("conv_id", "turn", generation_config(t).alias("config"), generation_config(t, "phi").alias("phi_config"))


def p7_prompt(spark, sf_dir):
    """Prompts of the user's turns for every chat family, with the conversation's system text, the turn before as context, and once without reasoning."""
    w = Window.partitionBy("conv_id")
    rows = _turns(spark, sf_dir).withColumn("system", F.max(F.when(F.col("role") == "system", F.col("text"))).over(w)).withColumn("context", F.lag("text").over(w.orderBy("turn"))).where("role = 'user'")
    made = [(f, True) for f in FAMILIES] + [("deepseek", False)]
    each = F.explode(F.array(*[F.struct(F.lit(f if show else f + "-plain").alias("family"), F.md5(format_prompt(F.col("text"), f, F.col("system"), F.col("context"), show)).alias("prompt_md5")) for f, show in made]))
    return rows.select("conv_id", "turn", each.alias("x")).select("conv_id", "turn", "x.*")


def w2_context(spark, sf_dir):
    return rolling_context(_turns(spark, sf_dir)).select("conv_id", "turn", F.md5("context").alias("context_md5"))


def p1_projection(spark, sf_dir):
    """What training reads of a pair: its text, input, output and where they come from."""
    rows = paired(_turns(spark, sf_dir))
    meta = F.to_json(F.struct(F.col("conv_id").cast("string").alias("conversation_id"), F.col("turn").cast("string").alias("message_id"), F.lit("conversation").alias("source")))
    text = F.concat(F.lit("<|user|>"), "user", F.lit("<|assistant|>"), "assistant", F.lit("<|endoftext|>"))
    return rows.select(F.md5(text).alias("text_md5"), F.col("user").alias("input"), F.col("assistant").alias("output"), meta.alias("source_metadata"))


def a1_pairs(spark, sf_dir):
    """Curated turns (valid, the first of equal texts) as pairs."""
    _turns(spark, sf_dir).createOrReplaceTempView("conversations")
    known = labels.labelled(labels.candidates(labels.turns(spark, sf_dir)))
    found = conversational_pairs(spark.sql(curated(Spark())), known)
    return found.select("conv_id", "turn", F.md5("text").alias("text_md5"), "user_len", "assistant_len", "user_words", "assistant_words", *[F.round(F.col(c) + 1e-9, 5).alias(c) for c in ROUNDED], F.array_join("themes", "|").alias("themes"))


def q_pair(spark, sf_dir):
    found = assess(paired(_turns(spark, sf_dir)), "user", "assistant")
    return found.select("conv_id", "turn", *[F.round(F.col(c) + 1e-9, 5).alias(c) for c in ROUNDED])


def q_sem(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", F.round(coherence_column(F.col("text")), 6).alias("coherence"))


def q_all(spark, sf_dir):
    return composite_quality(spark, sf_dir).select("doc_id", "quality")


def f5_gate(spark, sf_dir):
    return composite_quality(spark, sf_dir).where(F.col("quality") >= CHUNK_GATE).select("doc_id")


def _asked(spark, sf_dir):
    found = labels.labelled(labels.candidates(labels.documents(spark, sf_dir)))
    return prompts(labels.documents(spark, sf_dir).join(found.select("id", F.col("primary_theme").alias("theme")), "id"))


def t9_prompts(spark, sf_dir):
    return _asked(spark, sf_dir).select(F.col("id").alias("doc_id"), "question")


def a2_document_qa(spark, sf_dir):
    """Questions on a sample of each source's better documents, with the cut text as answer; pairs of the gate's score or more."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source")
    w = Window.partitionBy("source").orderBy(F.md5(F.concat(F.lit("42:"), F.col("doc_id").cast("string"))), "doc_id")
    sample = docs.withColumn("r", F.row_number().over(w)).where(F.col("r") <= PER_SOURCE).select("doc_id", "source")
    good = composite_quality(spark, sf_dir).where(F.col("quality") >= CHUNK_GATE).select("doc_id", answer_of(F.col("text")).alias("answer")).join(sample, "doc_id")
    rows = assess(good.join(_asked(spark, sf_dir).withColumnRenamed("id", "doc_id"), "doc_id"), "question", "answer").where(F.round("score", 9) >= PAIR_GATE)
    return rows.select("doc_id", "source", "question", F.md5("answer").alias("answer_md5"), F.round(F.col("score") + 1e-9, 5).alias("score"))


QUERIES = {
    "F10_retrieval_needed": f10_retrieval, "F11_memory_context": f11_memory, "F14_expert_predicates": f14_experts, "F15_plan_router": f15_router, "F16_generation_config": f16_config, "P7_prompt": p7_prompt, "W2_context": w2_context,
    "P1_training_projection": p1_projection, "A1_pairs": a1_pairs, "Q_pair": q_pair, "Q_sem": q_sem, "Q_all": q_all, "F5_quality_gate": f5_gate, "T9_prompts": t9_prompts, "A2_document_qa": a2_document_qa,
}


def _in(parts_: list[str], x: str = "text") -> str:
    return f"len(list_filter([{', '.join(chr(39) + p + chr(39) for p in parts_)}], lambda k: contains(lower({x}), k))) > 0"


def _n(x: str = "text") -> str:
    return rf"len(list_filter(string_split_regex({x}, '\s+'), lambda w: w <> ''))"


def _trim(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


_PAIRED = f"""(SELECT conv_id, turn, user_turn, {_trim('p')} AS u, {_trim('text')} AS a FROM (SELECT conv_id, turn, role, text, lag(role) OVER w AS pr, lag(text) OVER w AS p, lag(turn) OVER w AS user_turn FROM {{src}} WHERE {_trim('text')} <> '' WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) z WHERE role = 'assistant' AND pr = 'user')"""


def _slots(source: str, key: str, text: str) -> str:
    """(key, slot, v): signed word counts of a text."""
    return rf"SELECT {key}, h % 64 AS slot, sum(CASE WHEN h >= 2147483648 THEN 1 ELSE -1 END) AS v FROM (SELECT {key}, CAST('0x' || substr(md5(unnest(regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]+'))), 1, 8) AS BIGINT) AS h FROM {source}) hh GROUP BY {key}, slot"


def _cosine(a: str, b: str, key: str) -> str:
    """(key, c) of two tables of slots; pairs with a zero vector are missing."""
    keys = [k.strip() for k in key.split(",")]
    on = " AND ".join(f"x.{k} = y.{k}" for k in keys)
    cols = ", ".join(f"x.{k}" for k in keys)
    norm = lambda t: f"(SELECT {key}, sqrt(sum(v * v)) AS n FROM {t} GROUP BY {key})"
    return f"SELECT {cols}, sum(x.v * y.v) / any_value(nx.n * ny.n) AS c FROM {a} x JOIN {b} y ON {on} AND x.slot = y.slot JOIN {norm(a)} nx ON {on.replace('y.', 'nx.')} JOIN {norm(b)} ny ON {on.replace('x.', 'ny.')} WHERE nx.n > 0 AND ny.n > 0 GROUP BY {cols}"


def _assessed(source: str, key: str, u: str, a: str) -> str:
    """Common tables us, as_, sim, m (with all measures and the score) over a table of pairs."""
    return rf"""us AS ({_slots(source, key, u)}), as_ AS ({_slots(source, key, a)}), sim AS ({_cosine('us', 'as_', key)}),
m0 AS (SELECT p.*, length({u}) AS user_len, length({a}) AS assistant_len, {_n(u)} AS user_words, {_n(a)} AS assistant_words, round(coalesce(s.c, 0), 9) AS similarity,
  CASE WHEN length({u}) > 0 THEN length({a}) / length({u}) ELSE 0 END AS ratio, least(1e0, 20 / greatest({_n(a)} / len(string_split_regex({a}, '[.!?]+')), 1)) AS readability,
  len(list_distinct(list_filter(string_split_regex(lower({a}), '\s+'), lambda w: w <> ''))) / greatest({_n(a)}, 1) AS density FROM {source} p LEFT JOIN sim s ON {' AND '.join(f'p.{k.strip()} = s.{k.strip()}' for k in key.split(','))}),
m AS (SELECT *, CASE WHEN ratio >= 0.1e0 AND ratio <= 10 THEN 1e0 ELSE 0.5e0 END * CASE WHEN similarity >= 0.1e0 AND similarity <= 0.95e0 THEN 1e0 ELSE 0.7e0 END * (0.7e0 + 0.3e0 * readability) * (0.8e0 + 0.2e0 * density) AS score FROM m0)"""


_R5 = ", ".join(f"round({c} + 1e-9, 5) AS {c}" for c in ROUNDED)


def _coherent() -> str:
    """Common tables that end in coh (doc_id, coherence)."""
    return rf"""s1 AS (SELECT doc_id, unnest(list_transform(parts, lambda s, i: {{'i': i, 's': s}})) AS x FROM (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[.!?]+'), lambda s: {_trim('s')} <> '') AS parts FROM documents) p),
sent AS (SELECT doc_id, x.i AS i, x.s AS s FROM s1), slot_ AS ({_slots('sent', 'doc_id, i', 's')}), prev AS (SELECT doc_id, i + 1 AS i, slot, v FROM slot_), near AS ({_cosine('slot_', 'prev', 'doc_id, i')}),
n_ AS (SELECT doc_id, count(*) AS k FROM sent GROUP BY doc_id),
coh AS (SELECT d.doc_id, CASE WHEN coalesce(n.k, 0) < 2 THEN 0.5e0 ELSE coalesce(t.total, 0) / (n.k - 1) END AS coherence FROM documents d LEFT JOIN n_ n ON d.doc_id = n.doc_id LEFT JOIN (SELECT doc_id, sum(c) AS total FROM near GROUP BY doc_id) t ON d.doc_id = t.doc_id)"""


_SENT3 = f"len(list_filter(string_split_regex(text, '[.!?]+'), lambda s: {_n('s')} >= 3))"
_MEASURES = rf"""SELECT d.doc_id, d.text, c.coherence,
  CASE WHEN length(text) BETWEEN 100 AND 2000 AND {_n()} BETWEEN 20 AND 400 THEN 1e0 WHEN length(text) BETWEEN 50 AND 3000 AND {_n()} BETWEEN 10 AND 500 THEN 0.7e0 WHEN length(text) >= 10 AND {_n()} >= 3 THEN 0.4e0 ELSE 0.1e0 END AS ql,
  least(0.3e0 * {_SENT3} / len(string_split_regex(text, '[.!?]+')) + CASE WHEN regexp_matches(text, '[A-Z]') THEN 0.2e0 ELSE 0 END + 0.3e0, 1e0) AS qc,
  CASE WHEN {_n()} = 0 THEN 0e0 ELSE least(0.3e0 * len(list_distinct(list_filter(string_split_regex(lower(text), '\s+'), lambda w: w <> ''))) / {_n()} + CASE WHEN regexp_matches(text, '[0-9]') THEN 0.2e0 ELSE 0 END + 0.3e0, 1e0) END AS qi,
  CASE WHEN {_SENT3} >= 2 THEN 0.4e0 ELSE 0 END + CASE WHEN regexp_matches(text, '[.!?][ \n\t]*$') THEN 0.3e0 ELSE 0 END + 0.3e0 AS qs,
  CASE WHEN regexp_matches(text, '[ \n\t]{{3,}}') THEN 0e0 ELSE 0.25e0 END + CASE WHEN (upper(text) = text AND lower(text) <> text) OR (lower(text) = text AND upper(text) <> text) THEN 0e0 ELSE 0.25e0 END
   + CASE WHEN len(list_distinct(list_filter(string_split(lower(text), ''), lambda x: x <> ''))) >= 20 THEN 0.25e0 ELSE 0 END + 0.25e0 AS qn
  FROM documents d JOIN coh c ON d.doc_id = c.doc_id"""
_QUALITY = f"{_coherent()}, meas AS ({_MEASURES}), qual AS (SELECT doc_id, text, round(0.10e0 * ql + 0.20e0 * qc + 0.20e0 * qi + 0.15e0 * qs + 0.15e0 * qn + 0.20e0 * round(coherence, 9) + 1e-9, 3) AS quality FROM meas)"
_BORDERED = labels._ASCII.replace("text", "{x}")


def _rfind(x: str, p: str) -> str:
    """Place from 0 of the last occurrence, -1 if there is none."""
    return f"CASE WHEN contains({x}, '{p}') THEN length({x}) - length({p!r}) - strpos(reverse({x}), '{p[::-1]}') + 1 ELSE -1 END"


def _truncated(x: str) -> str:
    cut = f"substring({x}, 1, 500)"
    end = f"greatest({_rfind(cut, '. ')}, {_rfind(cut, '? ')}, {_rfind(cut, '! ')})"
    space = _rfind(cut, " ")
    return f"CASE WHEN length({x}) <= 500 THEN {x} WHEN {end} <> -1 THEN substring({cut}, 1, {end} + 1) WHEN {space} <> -1 THEN substring({cut}, 1, {space}) ELSE {cut} END"


def _asked_sql() -> str:
    """Common tables that end in asked (id, question); after the documents' chain."""
    rows = []
    for k, t in enumerate(TEMPLATES):
        q = "'" + t.replace("'", "''") + "'"
        for name in ("first", "theme", "term"):
            if "{" + name + "}" in t:
                q = f"replace({q}, '{{{name}}}', {name}_)"
        rows.append(f"SELECT id, {k} AS k, {q} AS question FROM base{' WHERE term_ IS NOT NULL' if '{term}' in t else ''}")
    terms = rf"regexp_extract_all({labels._ASCII}, '\b[A-Z][a-z]+(?:\s[A-Z][a-z]+)?\b')"
    return rf"""para AS (SELECT l.id, l.text, {_trim("string_split_regex(l.text, '\n\n+')[1]")} AS para, l.themes[1] AS theme_ FROM d_lab l),
terms AS (SELECT id, arg_min(t, md5('42:' || id || ':' || t)) AS term_ FROM (SELECT id, unnest({terms}) AS t FROM para) x GROUP BY id),
base AS (SELECT p.id, {_truncated('p.para')} AS first_, theme_, term_ FROM para p LEFT JOIN terms t ON p.id = t.id),
asked0 AS ({' UNION ALL '.join(rows)}),
asked AS (SELECT id, question FROM (SELECT id, question, row_number() OVER (PARTITION BY id ORDER BY md5('42:' || id || ':' || k), k) AS r FROM asked0) z WHERE r <= 4)"""


def _answer() -> str:
    cut = r"array_to_string(list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')[1:200], ' ')"
    end = f"greatest({_rfind(cut, '. ')}, {_rfind(cut, '? ')}, {_rfind(cut, '! ')})"
    return f"CASE WHEN {_n()} <= 200 THEN text WHEN {end} > length({cut}) * 0.7 THEN substring({cut}, 1, {end} + 1) ELSE {cut} || '...' END"


_VALID = rf"length({_trim('text')}) BETWEEN 20 AND 10000 AND {_n()} >= 3 AND (length(text) - length(regexp_replace(text, '[^\p{{L}}]', '', 'g'))) / length(text) <= 0.6"
_CURATED = f"(SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY conv_id, turn) AS r FROM conversations WHERE {_VALID}) v WHERE r = 1)"


def _prompt(family: str, show: bool) -> str:
    lit = lambda x: "'" + x.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    sys = "coalesce(sys, '')"
    if not show:
        sys = f"CASE WHEN {sys} <> '' THEN sys || chr(10) || chr(10) ELSE '' END || '{NO_REASONING}'"
    front = f"'Instructions: ' || ({sys}) || chr(10) || chr(10) || 'Question: '" if family == "phi" else f"'[System: ' || ({sys}) || ']' || chr(10) || chr(10)"
    body = f"CASE WHEN ({sys}) <> '' THEN {front} ELSE '' END || CASE WHEN coalesce(ctx, '') <> '' THEN '[Context from memory:' || chr(10) || ctx || ']' || chr(10) || chr(10) ELSE '' END || text"
    marks = {
        "gemma": ("<start_of_turn>user\n", "<end_of_turn>\n<start_of_turn>model\n"), "llama": ("<|start_header_id|>user<|end_header_id|>\n\n", "<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n"),
        "mistral": ("", " [/INST]"), "phi": ("<|user|>\n", "<|end|>\n<|assistant|>\n"),
    }.get(family, ("<|im_start|>user\n", "<|im_end|>\n<|im_start|>assistant\n"))
    return f"SELECT conv_id, turn, '{family if show else family + '-plain'}' AS family, md5({lit(marks[0])} || {body} || {lit(marks[1])}) AS prompt_md5 FROM t"


ORACLE_SQL = {
    "F10_retrieval_needed": f"SELECT conv_id, turn, CASE WHEN {_in(RECALL)} OR {_n()} >= 5 THEN 1 ELSE 0 END AS wanted FROM conversations",
    "F11_memory_context": f"SELECT conv_id, turn, CASE WHEN {_in(MEMORY)} THEN 1 ELSE 0 END AS wanted FROM conversations",
    "F14_expert_predicates": f"""SELECT c.conv_id, turn, CASE WHEN r THEN 1 ELSE 0 END AS retrieve, CASE WHEN s THEN 1 ELSE 0 END AS summarise, CASE WHEN contains(lower(text), 'rehearse') AND g.q = 0 THEN 1 ELSE 0 END AS rehearse, CASE WHEN length(text) > 100 THEN 'System-2' ELSE 'System-1' END AS mode,
  CASE WHEN r AND s THEN 'RETRIEVE,SUMMARIZE' WHEN r THEN 'RETRIEVE' WHEN s THEN 'SUMMARIZE' END AS plan FROM (SELECT *, {_in(['retrieve', 'find'])} AS r, length(text) > 100 OR contains(lower(text), 'summarize') AS s FROM conversations) c LEFT JOIN (SELECT doc_id, max(quality) AS q FROM labels GROUP BY doc_id) g ON g.doc_id = c.conv_id""",
    "F15_plan_router": """WITH f AS (SELECT user_id, event_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) x WHERE r <= 2 AND event_type <> 'view'),
k AS (SELECT e.event_id, e.user_id, e.event_type IN ('SET_PLAN', 'SET_MODE') OR EXISTS (SELECT 1 FROM f WHERE f.user_id = e.user_id AND f.event_type = e.event_type) AS ok FROM events e)
SELECT event_id FROM k WHERE ok OR user_id NOT IN (SELECT user_id FROM k WHERE ok) OR user_id NOT IN (SELECT user_id FROM f)""",
    "F16_generation_config": f"SELECT conv_id, turn, CASE WHEN {_in(CREATIVE)} THEN 1 WHEN {_n()} < 5 THEN 2 ELSE 0 END AS config, 2 AS phi_config FROM conversations",
    "P7_prompt": "WITH t AS (SELECT * FROM (SELECT conv_id, turn, role, text, max(CASE WHEN role = 'system' THEN text END) OVER (PARTITION BY conv_id) AS sys, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS ctx FROM conversations) x WHERE role = 'user') "
    + " UNION ALL ".join([_prompt(f, True) for f in FAMILIES] + [_prompt("deepseek", False)]),
    "W2_context": f"""WITH p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM {_PAIRED.format(src='conversations')} q),
l AS (SELECT conv_id, turn, unnest([{{'k': 1, 't': 'User: ' || u}}, {{'k': 2, 't': 'Assistant: ' || a}}]) AS x FROM p),
n AS (SELECT c.conv_id, c.turn, l.x.t AS t, row_number() OVER (PARTITION BY c.conv_id, c.turn ORDER BY l.turn DESC, l.x.k DESC) AS back FROM conversations c JOIN l ON l.conv_id = c.conv_id AND l.turn < c.turn WHERE c.role = 'user')
SELECT c.conv_id, c.turn, md5(coalesce(s.t, '')) AS context_md5 FROM conversations c LEFT JOIN (SELECT conv_id, turn, string_agg(t, ' ' ORDER BY back DESC) AS t FROM n WHERE back <= 3 GROUP BY conv_id, turn) s ON s.conv_id = c.conv_id AND s.turn = c.turn WHERE c.role = 'user' AND {_trim('c.text')} <> ''""",
    "P1_training_projection": f"""SELECT md5('<|user|>' || u || '<|assistant|>' || a || '<|endoftext|>') AS text_md5, u AS input, a AS output, '{{"conversation_id":"' || conv_id || '","message_id":"' || turn || '","source":"conversation"}}' AS source_metadata FROM {_PAIRED.format(src='conversations')} p""",
    "Q_pair": f"WITH pr AS (SELECT * FROM {_PAIRED.format(src='conversations')} p), {_assessed('pr', 'conv_id, turn', 'u', 'a')} SELECT conv_id, turn, {_R5} FROM m",
    "A1_pairs": f"""WITH {_CONV}, pr AS (SELECT * FROM {_PAIRED.format(src=_CURATED + ' cur')} p), {_assessed('pr', 'conv_id, turn', 'u', 'a')}
SELECT m.conv_id, m.turn, md5('<|user|>' || u || '<|assistant|>' || a || '<|endoftext|>') AS text_md5, user_len, assistant_len, user_words, assistant_words, {_R5}, array_to_string(l.themes, '|') AS themes FROM m LEFT JOIN c_lab l ON l.id = m.conv_id * 1000 + m.turn WHERE round(score, 9) >= 0.46""",
    "Q_sem": f"WITH {_coherent()} SELECT doc_id, round(coherence, 6) AS coherence FROM coh",
    "Q_all": f"WITH {_QUALITY} SELECT doc_id, quality FROM qual",
    "F5_quality_gate": f"WITH {_QUALITY} SELECT doc_id FROM qual WHERE quality >= 0.4",
    "T9_prompts": f"WITH {_DOCS}, {_asked_sql()} SELECT id AS doc_id, question FROM asked",
    "A2_document_qa": f"""WITH {_DOCS}, {_asked_sql()}, {_QUALITY},
good AS (SELECT q.doc_id, s.source, {_answer().replace('text', 'q.text')} AS a FROM qual q JOIN (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('42:' || doc_id), doc_id) AS r FROM documents) s ON s.doc_id = q.doc_id WHERE q.quality >= 0.4 AND s.r <= 1666),
pr AS (SELECT row_number() OVER (ORDER BY g.doc_id, k.question) AS key, g.doc_id, g.source, k.question AS u, g.a FROM good g JOIN asked k ON k.id = g.doc_id), {_assessed('pr', 'key', 'u', 'a')}
SELECT doc_id, source, u AS question, md5(a) AS answer_md5, round(score + 1e-9, 5) AS score FROM m WHERE round(score, 9) >= 0.46""",
}
