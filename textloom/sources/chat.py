"""Chat exports and page documents as rows.

Exports are JSON in any of five containers: a list of conversations, an object
with ``conversations``, an object of id to conversation or message list, one
conversation, one message. Messages stand in ``chat_messages``, ``messages`` or a
``mapping`` of nodes. Values stay VARIANT until a field is taken, so files of
different shapes can be read together. Files are the unit of parallelism.
Malformed files and messages without any text yield no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _v(value: str, path: str) -> str:
    return f"try_variant_get({value}, '$.{path}', 'variant')"


def _s(value: str, path: str = "") -> str:
    """A string or number as string; null for empty ones, zero and containers."""
    at = f"'$.{path}'" if path else "'$'"
    got = f"try_variant_get({value}, {at}, 'string')"
    kind = f"schema_of_variant(try_variant_get({value}, {at}, 'variant'))"
    return f"CASE WHEN {kind} LIKE 'ARRAY%' OR {kind} LIKE 'OBJECT%' OR {got} IN ('', '0') THEN NULL ELSE {got} END"


def _content(value: str) -> str:
    """Text of a content field: a string, the first of ``parts``, ``text``, or a list of strings or texts joined by blanks."""
    items = f"CASE WHEN schema_of_variant({value}) LIKE 'ARRAY%' THEN try_variant_get({value}, '$', 'array<variant>') END"
    listed = f"nullif(array_join(transform({items}, i -> coalesce({_s('i')}, {_s('i', 'text')}, {_s('i', 'content')}, '')), ' '), '')"
    return f"coalesce({_s(value)}, {_s(value, 'parts[0]')}, {_s(value, 'text')}, {listed})"


def read_chats(spark: SparkSession, path: str) -> DataFrame:
    """(conversation_id, ordinal, message_id, author, text, timestamp) of all exports below a path."""
    files = spark.read.text(path, wholetext=True).select(F.expr("try_parse_json(value)").alias("v"), F.xxhash64("value").alias("file"))
    return chats(files)


def chats(files: DataFrame) -> DataFrame:
    """As read_chats, from rows (v VARIANT, file: an id)."""
    kind = "schema_of_variant({}) LIKE '{}%'".format
    held = f"coalesce({_v('v', 'conversations')}, v)"
    # A conversation or message by itself counts as a list of one.
    one = " OR ".join(f"{_v('v', k)} IS NOT NULL" for k in ("mapping", "messages", "chat_messages", "role", "author", "sender"))
    top = files.where("v IS NOT NULL").selectExpr("file", f"{held} AS held", f"{kind('v', 'OBJECT')} AND ({one}) AS single")
    many = top.where("NOT single").lateralJoin(top.sparkSession.tvf.variant_explode(F.col("held").outer())).selectExpr("file", "pos", "key", "value AS conv")
    convs = many.unionByName(top.where("single").selectExpr("file", "0 AS pos", "CAST(NULL AS STRING) AS key", "held AS conv"))
    convs = convs.where("conv IS NOT NULL").selectExpr(
        "file",
        f"coalesce({_s('conv', 'uuid')}, {_s('conv', 'id')}, {_s('conv', 'conversation_id')}, key, CAST(pos AS STRING)) AS conversation_id",
        f"coalesce({_v('conv', 'chat_messages')}, {_v('conv', 'messages')}, {_v('conv', 'mapping')}, CASE WHEN {kind('conv', 'ARRAY')} THEN conv END) AS list",
        "conv",
    )
    listed = convs.where("list IS NOT NULL").lateralJoin(convs.sparkSession.tvf.variant_explode(F.col("list").outer()))
    # Nodes of a mapping hold the message; elsewhere ``message`` may be the text itself.
    node = f"CASE WHEN {kind(_v('value', 'message'), 'OBJECT')} AND {_v('value', 'role')} IS NULL THEN {_v('value', 'message')} ELSE value END"
    messages = listed.selectExpr("file", "conversation_id", "CAST(pos AS BIGINT) AS ordinal", f"{node} AS m").unionByName(
        convs.where("list IS NULL").selectExpr("file", "conversation_id", "0L AS ordinal", "conv AS m")
    )
    who = f"lower(coalesce({_s('m', 'author')}, {_s('m', 'author.role')}, {_s('m', 'author.name')}, {_s('m', 'role')}, {_s('m', 'sender')}, 'unknown'))"
    text = " , ".join(_content(_v("m", k)) for k in ("text", "content", "message"))
    return messages.selectExpr(
        "conversation_id",
        "ordinal",
        f"coalesce({_s('m', 'uuid')}, {_s('m', 'id')}, CAST(ordinal AS STRING)) AS message_id",
        f"CASE WHEN {who} IN ('human', 'user') THEN 'user' WHEN {who} IN ('assistant', 'ai', 'claude') THEN 'assistant' ELSE {who} END AS author",
        f"coalesce({text}) AS text",
        f"coalesce({', '.join(_s('m', k) for k in ('created_at', 'updated_at', 'timestamp', 'create_time', 'time'))}) AS timestamp",
    ).where("text IS NOT NULL")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(filename, text) of page documents: the first string of text, content, total_text and body."""
    rows = spark.read.text(path, wholetext=True).select(F.expr("try_parse_json(value)").alias("v")).where("v IS NOT NULL")
    items = rows.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
    body = ", ".join(_s("value", k) for k in ("text", "content", "total_text", "body"))
    return items.selectExpr(f"coalesce({_s('value', 'filename')}, concat('document_', pos, '.pdf')) AS filename", f"coalesce({body}) AS text").where("text IS NOT NULL")


def html_text(html):
    """Visible text of a page: without scripts, styles, comments and tags, common entities read, blanks squeezed."""
    for pattern, to in [(r"(?is)<(script|style)\b.*?</\1\s*>", " "), (r"(?s)<!--.*?-->", " "), (r"(?s)<[^>]*>", " "), ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"), (r"(?U)\s+", " ")]:
        html = F.regexp_replace(html, pattern, to)
    return F.trim(html)
