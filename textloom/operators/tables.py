"""Themes, aggregates, windows, vectors, memory state and joins."""

from __future__ import annotations

from textloom.operators.text import doubles


def g9_stats(q):
    return "SELECT lang, round(avg(n_chars), 4) AS mean, round(stddev_pop(n_chars), 4) AS std, min(n_chars) AS low, max(n_chars) AS high FROM documents GROUP BY lang"


def g11_sources(q):
    return "SELECT source, n, round(100.0 * n / CAST(sum(n) OVER () AS DOUBLE), 4) AS percent FROM (SELECT source, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY source) s"


def g12_totals(q):
    return "SELECT lang, source, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY ROLLUP (lang, source)"


def g19_experts(q):
    return doubles(q, "SELECT event_type, CAST(count(*) AS BIGINT) AS calls, CAST(sum(CASE WHEN value > 50 THEN 1 ELSE 0 END) AS BIGINT) AS success, round(avg(CASE WHEN value > 50 THEN 1D ELSE 0D END), 6) AS success_rate, round(avg(value), 4) AS mean_time FROM events GROUP BY event_type")


def g21_recent(q):
    return "SELECT event_type, round(avg(value), 5) AS mean FROM (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS r FROM events) s WHERE r <= 20 GROUP BY event_type"


def g22_rate(q):
    return f"SELECT event_id, {q.micros('ts')} - lag({q.micros('ts')}) OVER (PARTITION BY user_id ORDER BY event_id) AS gap_us FROM events"


def g23_cache(q):
    return "SELECT user_id, CAST(count(*) AS BIGINT) AS accesses, CAST(count(DISTINCT event_type) AS BIGINT) AS misses, CAST(count(*) - count(DISTINCT event_type) AS BIGINT) AS hits, round((count(*) - count(DISTINCT event_type)) / CAST(count(*) AS DOUBLE), 6) AS hit_rate, CAST(count(DISTINCT event_type) AS BIGINT) AS held FROM events GROUP BY user_id"


def g24_lengths(q):
    return "SELECT min(n_chars) AS low, max(n_chars) AS high, round(avg(n_chars), 5) AS mean FROM (SELECT n_chars FROM documents ORDER BY doc_id LIMIT 1000) s"


def l6_per_source(q):
    return "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY md5(concat('42:', CAST(doc_id AS VARCHAR(20)))), doc_id) AS r FROM documents) s WHERE r <= 1666"


def l7_cap(q):
    return "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) s WHERE r <= 1250"


def w10_session(q):
    us = q.micros("ts")
    return f"SELECT event_id, CAST(count(*) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN 899999999 PRECEDING AND CURRENT ROW) AS BIGINT) AS n FROM (SELECT event_id, user_id, {us} AS us FROM events) s"


def w13_align(q):
    return "SELECT coalesce(a.user_id, b.user_id) AS step, a.n AS clicks, b.n AS views FROM (SELECT user_id, CAST(count(*) AS BIGINT) AS n FROM events WHERE event_type = 'click' GROUP BY user_id) a FULL OUTER JOIN (SELECT user_id, CAST(count(*) AS BIGINT) AS n FROM events WHERE event_type = 'view' GROUP BY user_id) b ON a.user_id = b.user_id"


def v2_norm(q):
    return f"SELECT vec_id, round(sqrt({q.dot('embedding', 'embedding')}), 4) AS norm FROM embeddings"


def f8_dimension(q):
    return f"SELECT vec_id FROM embeddings WHERE {q.size('embedding')} = 64"


def f7_zero(q):
    return f"SELECT vec_id FROM embeddings WHERE {q.size(q.keep('embedding', 'x', 'x <> 0'))} > 0"


def v8_feedback(q):
    return "SELECT e.vec_id, round(coalesce(r.reward, 0), 4) AS b FROM embeddings e LEFT JOIN (SELECT event_id % 1000 AS vec_id, sum(value) AS reward FROM events GROUP BY event_id % 1000) r ON e.vec_id = r.vec_id"


def j10_new(q):
    return "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"


def j11_known(q):
    return "SELECT doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"


def j6_lookup(q):
    return "SELECT d.doc_id, coalesce(l.quality, 0) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


def j1_zip(q):
    return "SELECT d.doc_id, d.lang, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id"


def u1_union(q):
    return "SELECT doc_id AS id, 'document' AS kind FROM documents UNION ALL SELECT page_id AS id, 'page' AS kind FROM pages"


def u3_intersect(q):
    return "SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels"


def u4_except(q):
    return "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels"


def v9_age(q):
    return f"SELECT event_id FROM events WHERE {q.micros('ts')} < {q.micros('TIMESTAMP ' + chr(39) + '2024-01-15 00:00:00' + chr(39))} - 604800000000"


def v13_turns(q):
    return "SELECT conv_id, turn, concat('User: ', p, '\n', 'Assistant: ', text) AS content FROM (SELECT conv_id, turn, role, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) s WHERE role = 'assistant' AND p IS NOT NULL".replace("\n", "' || chr(10) || '")


def x_json(q):
    return f"SELECT event_id, CAST({q.json('props', 'k')} AS BIGINT) AS k FROM events"


def s_tpch1(q):
    return "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, CAST(count(*) AS BIGINT) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus"


def s_join(q):
    return "SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name"


QUERIES = {
    "G9_quality_stats": g9_stats, "G11_source_distribution": g11_sources, "G12_totals": g12_totals, "G19_expert_stats": g19_experts, "G21_recent_average": g21_recent, "G22_step_gap": g22_rate, "G23_cache_stats": g23_cache, "G24_length_stats": g24_lengths,
    "L6_sample_per_source": l6_per_source, "L7_cap_per_source": l7_cap, "W10_session": w10_session, "W13_alignment": w13_align,
    "V2_norm": v2_norm, "V8_feedback": v8_feedback, "V9_age": v9_age, "V13_turns": v13_turns, "F7_zero_vector": f7_zero, "F8_dimension": f8_dimension, "J1_zip": j1_zip, "J6_lookup": j6_lookup,
    "J10_anti": j10_new, "J11_semi": j11_known, "U1_union": u1_union, "U3_intersect": u3_intersect, "U4_except": u4_except, "X_json": x_json, "STAR_pricing": s_tpch1, "STAR_joins": s_join,
}
