"""Filters, scores, chunkers and text scalars over documents and conversations."""

from __future__ import annotations

STOP = "'the','a','an','and','or','but','in','on','at','to','for','of','with','by','is','are','was','were','be','it','this','that'"


def valid(q, x, low=20, high=10000, words=3, ratio=0.6):
    s = q.strip(x)
    return f"({q.length(s)} BETWEEN {low} AND {high} AND {q.size(q.words(x))} >= {words} AND ({q.length(x)} - {q.letters(x)}) / CAST({q.length(x)} AS DOUBLE) <= {ratio})"


def f1_ingest(q):
    s = q.strip("text")
    return f"SELECT doc_id FROM documents WHERE {q.length(s)} >= 15 AND {q.size(q.words('text'))} >= 5 AND {q.letters(s)} / CAST({q.length(s)} AS DOUBLE) >= 0.4"


def f2_validate(q):
    return f"SELECT doc_id, CASE WHEN {valid(q, 'text')} THEN 1 ELSE 0 END AS ok FROM documents"


def f3_source(q):
    return "SELECT doc_id, source FROM documents WHERE source = 'src1'"


def f12_policy(q):
    hit = " OR ".join(q.contains("lower(text)", f"'{k}'") for k in ["abusive", "hateful", "illegal"])
    return f"SELECT conv_id, turn, CASE WHEN {hit} THEN 0 ELSE 1 END AS allowed FROM conversations"


def f13_unsafe(q):
    hit = " OR ".join(q.contains("lower(html)", f"'{k}'") for k in ["<script>", "javascript:", "eval("])
    return f"SELECT page_id, CASE WHEN {hit} OR length(html) NOT BETWEEN 1 AND 20000 THEN 1 ELSE 0 END AS unsafe FROM pages"


def p5_author(q):
    return "SELECT conv_id, turn, CASE WHEN lower(role) IN ('human', 'user') THEN 'user' WHEN lower(role) IN ('assistant', 'ai', 'claude') THEN 'assistant' WHEN role IS NULL OR role = '' THEN 'unknown' ELSE lower(role) END AS author FROM conversations"


def c7_summary(q):
    return "SELECT doc_id, concat(substring(text, 1, 100), '...') AS summary FROM documents"


def c11_cache_key(q):
    return f"SELECT conv_id, turn, md5({q.replace_all(q.strip('lower(text)'), q_ws(q), ' ')}) AS cache_key FROM conversations"


def q_ws(q):
    return r"\s+" if type(q).__name__ == "Oracle" else r"(?U)\s+"


def c8_truncate(q):
    # The last sentence end within 500 characters, else the last blank, else the hard cut.
    cut = "substring(text, 1, 500)"
    last = lambda p: f"(CASE WHEN {q.contains(cut, p)} THEN 500 - {pos(q, p)} - length({p}) + 2 ELSE 0 END)"
    ends = f"greatest({last(chr(39) + '. ' + chr(39))}, {last(chr(39) + '? ' + chr(39))}, {last(chr(39) + '! ' + chr(39))})"
    space = last("' '")
    return f"SELECT doc_id, md5(CASE WHEN length(text) <= 500 THEN text WHEN {ends} > 0 THEN substring(text, 1, {ends}) WHEN {space} > 1 THEN substring(text, 1, {space} - 1) ELSE {cut} END) AS cut_md5 FROM documents"


def pos(q, p):
    return f"instr(reverse(substring(text, 1, 500)), reverse({p}))"


def ends_at(q, x):
    """Where the last sentence mark stands (from 1; 0: none)."""
    last = lambda c: f"(CASE WHEN {q.contains(x, chr(39) + c + chr(39))} THEN length({x}) - instr(reverse({x}), '{c}') + 1 ELSE 0 END)"
    return f"greatest({last('.')}, {last('?')}, {last('!')})"


def c9_answer(q):
    # The first 200 words, up to the last sentence mark if that lies beyond 70 %, else marked as cut.
    short = f"SELECT doc_id, {q.size(q.words('text'))} AS n, {q.join(q.slice(q.words('text'), '1', '200'), ' ')} AS cut FROM documents"
    end = ends_at(q, "cut")
    return f"SELECT doc_id, md5(CASE WHEN n <= 200 THEN cut WHEN {end} - 1 > length(cut) * 0.7 THEN substring(cut, 1, {end}) ELSE concat(cut, '...') END) AS answer_md5 FROM ({short}) s"


def c10_speech(q):
    end = ends_at(q, "cut")
    return f"SELECT doc_id, md5(CASE WHEN n > 3500 AND {end} - 1 > 1750 THEN substring(cut, 1, {end}) ELSE cut END) AS spoken_md5 FROM (SELECT doc_id, length(text) AS n, substring(text, 1, 3500) AS cut FROM documents) s"


def c4_sanitise(q):
    clean = q.replace_all("text", r"[^\p{L}\p{N}_\s]", "")
    return f"SELECT conv_id, turn, md5({clean}) AS clean_md5, {clean} <> text AS changed FROM conversations"


def chunks(q, size, overlap, table="documents", key="doc_id"):
    step = max(1, size - overlap)
    base = f"(SELECT {key}, text, {q.words('text')} AS w FROM {table})"
    starts = q.explode(base, f"{key}, text, w", q.numbers("CAST(1 AS BIGINT)", f"greatest(CAST({q.size('w')} AS BIGINT), 1)", f"CAST({step} AS BIGINT)"))
    return starts, step


def t1_windows(q):
    starts, _ = chunks(q, 400, 50)
    single = f"({q.size('w')} <= 400 AND length(text) <= 2000)"
    body = q.join(q.slice("w", "CAST(item AS INT)", "400"), " ")
    return f"""SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS BIGINT) AS chunk_id,
      CAST(count(*) OVER (PARTITION BY doc_id) AS BIGINT) AS total_chunks, md5(chunk) AS chunk_md5 FROM (
        SELECT doc_id, pos, CASE WHEN {single} THEN text ELSE substring({body}, 1, 2000) END AS chunk FROM {starts} s
        WHERE pos = 0 OR NOT {single}) c WHERE length(chunk) >= 15"""


def t2_fixed(q):
    starts, _ = chunks(q, 500, 100)
    body = q.join(q.slice("w", "CAST(item AS INT)", "500"), " ")
    return f"SELECT doc_id, pos AS chunk_index, md5({body}) AS chunk_md5 FROM {starts} s WHERE {q.size('w')} > 0"


def d1_md5(q):
    return "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS r FROM documents) x WHERE r = 1"


def d2_clean(q):
    clean = q.replace_all(q.strip("lower(text)"), q_ws(q), " ")
    return f"SELECT min(doc_id) AS doc_id, CAST(count(*) AS BIGINT) AS copies FROM documents GROUP BY md5({clean})"


def d3_sha(q):
    h = "sha2(text, 256)" if type(q).__name__ == "Spark" else "sha256(text)"
    return f"SELECT min(doc_id) AS doc_id, {h} AS digest FROM documents GROUP BY {h}"


def d4_split(q):
    return "SELECT split, min(doc_id) AS doc_id FROM (SELECT doc_id, text, CASE WHEN doc_id % 10 < 8 THEN 'train' WHEN doc_id % 10 = 8 THEN 'validation' ELSE 'test' END AS split FROM documents) s GROUP BY split, md5(text)"


def d9_distinct(q):
    return f"SELECT doc_id, {q.size(q.distinct(q.words('text')))} AS n FROM documents"


def measured(q):
    """(doc_id, text, n characters, w words, all sentence parts, full ones of three words, uniq lower-cased words, kinds of characters), each counted once a text."""
    sents = q.sentences("text")
    full = q.size(q.keep(sents, "x", f"{q.size(q.words('x'))} >= 3"))
    return f"(SELECT doc_id, text, {q.length('text')} AS n, {q.size(q.words('text'))} AS w, {q.size(sents)} AS parts, {full} AS whole, {q.size(q.distinct(q.words('lower(text)')))} AS uniq, {q.size(q.distinct(q.chars('lower(text)')))} AS kinds FROM documents)"


def parts(q):
    """Scores over ``measured``."""
    return {
        "len_q": "CASE WHEN n BETWEEN 100 AND 2000 AND w BETWEEN 20 AND 400 THEN 1.0D WHEN n BETWEEN 50 AND 3000 AND w BETWEEN 10 AND 500 THEN 0.7D WHEN n >= 10 AND w >= 3 THEN 0.4D ELSE 0.1D END",
        "coh_q": f"least(0.3D * whole / CAST(parts AS DOUBLE) + CASE WHEN {q.matches('text', '[A-Z]')} THEN 0.2D ELSE 0D END + 0.3D, 1D)",
        "inf_q": f"CASE WHEN w = 0 THEN 0D ELSE least(0.3D * uniq / CAST(w AS DOUBLE) + CASE WHEN {q.matches('text', '[0-9]')} THEN 0.2D ELSE 0D END + 0.3D, 1D) END",
        "str_q": f"CASE WHEN whole >= 2 THEN 0.4D ELSE 0D END + CASE WHEN {q.matches('text', '[.!?][ ' + chr(92) + 'n' + chr(92) + 't]*$')} THEN 0.3D ELSE 0D END + 0.3D",
        "lin_q": f"CASE WHEN {q.matches('text', '[ ' + chr(92) + 'n' + chr(92) + 't]{3,}')} THEN 0D ELSE 0.25D END + CASE WHEN (upper(text) = text AND lower(text) <> text) OR (lower(text) = text AND upper(text) <> text) THEN 0D ELSE 0.25D END + CASE WHEN kinds >= 20 THEN 0.25D ELSE 0D END + 0.25D",
    }


def doubles(q, sql):
    import re

    return sql if type(q).__name__ == "Spark" else re.sub(r"(?<![\w.])(\d+(?:\.\d+)?)D\b", r"CAST(\1 AS DOUBLE)", sql)


def half_up(x, n):
    """Rounds so that a value within 1e-9 below a half goes up: sums may end on either side of it."""
    return f"round({x} + 0.000000001D, {n})"


def q_scores(q):
    p = parts(q)
    cols = ", ".join(f"{half_up(v, 6)} AS {k}" for k, v in p.items())
    return doubles(q, f"SELECT doc_id, {cols} FROM {measured(q)} m")


def a3_sentences(q):
    return f"SELECT doc_id, CAST(count(*) AS BIGINT) AS n, CAST(sum({q.length('item')}) AS BIGINT) AS chars FROM {q.explode('documents', 'doc_id', q.sentences('text'))} s GROUP BY doc_id"


PAIR_BASE = """SELECT conv_id, turn, role, text, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_role,
  lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_text FROM ({src}) k"""


def curated(q):
    first = "SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY md5(text) ORDER BY conv_id, turn) AS r FROM conversations WHERE " + valid(q, "text")
    return f"SELECT conv_id, turn, role, text FROM ({first}) f WHERE r = 1"


def j2_pairing(q):
    return f"SELECT conv_id, turn, md5(prev_text) AS user_md5, md5(text) AS assistant_md5 FROM ({PAIR_BASE.format(src='SELECT * FROM conversations WHERE ' + q.strip('text') + ' <> ' + chr(39) * 2)}) p WHERE role = 'assistant' AND prev_role = 'user'"


def w1_order(q):
    return "SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS ordinal FROM conversations"


def w7_splits(q):
    return """SELECT doc_id, split, block FROM (SELECT doc_id, block, CASE WHEN o <= floor(0.8 * n) THEN 'train' WHEN o <= floor(0.8 * n) + floor(0.1 * n) THEN 'validation' ELSE 'test' END AS split
      FROM (SELECT doc_id, block, n, row_number() OVER (ORDER BY block, md5(concat('42:', CAST(doc_id AS VARCHAR(20)))), doc_id) AS o
        FROM (SELECT doc_id, n, CAST(least(floor((r - 1) / greatest(floor(n / 4), 1)), 3) AS BIGINT) AS block
          FROM (SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS r, count(*) OVER () AS n FROM documents) a) b) c) d"""


QUERIES = {
    "F1_ingest_validator": f1_ingest, "F2_formatter_validator": f2_validate, "F3_source_filter": f3_source, "F12_policy": f12_policy, "F13_unsafe_prompt": f13_unsafe, "P5_author": p5_author, "C7_summary_stub": c7_summary, "C8_smart_truncate": c8_truncate, "C11_cache_key": c11_cache_key, "C4_sanitise": c4_sanitise, "C9_answer_truncate": c9_answer, "C10_speech_truncate": c10_speech, "T1_word_windows": t1_windows,
    "T2_fixed_chunks": t2_fixed, "D1_exact_dedup": d1_md5, "D2_clean_dedup": d2_clean, "D3_sha_dedup": d3_sha, "D4_split_dedup": d4_split, "D9_ordered_distinct": d9_distinct,
    "Q_scores": q_scores, "T3_sentences": a3_sentences, "J2_pairing": j2_pairing, "W1_order": w1_order, "A5_splits": w7_splits,
}
