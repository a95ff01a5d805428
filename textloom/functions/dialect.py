"""Expressions that Spark SQL and the oracle's SQL spell differently. An operator is a function of a dialect that returns a query."""

from __future__ import annotations


class Spark:
    """Spark SQL."""

    def strip(self, x: str) -> str:
        return rf"regexp_replace({x}, r'(?U)^\s+|\s+$', '')"

    def words(self, x: str) -> str:
        return rf"filter(split({x}, r'(?U)\s+'), w -> w <> '')"

    def sentences(self, x: str) -> str:
        return f"split({x}, '[.!?]+')"

    def letters(self, x: str) -> str:
        return rf"length(regexp_replace({x}, r'[^\p{{L}}]', ''))"

    def size(self, x: str) -> str:
        return f"CAST(size({x}) AS BIGINT)"

    def length(self, x: str) -> str:
        return f"CAST(length({x}) AS BIGINT)"

    def distinct(self, x: str) -> str:
        return f"array_distinct({x})"

    def keep(self, x: str, var: str, test: str) -> str:
        return f"filter({x}, {var} -> {test})"

    def matches(self, x: str, pattern: str) -> str:
        return f"({x} RLIKE r'{pattern}')"

    def contains(self, x: str, part: str) -> str:
        return f"contains({x}, {part})"

    def replace_all(self, x: str, pattern: str, to: str) -> str:
        return f"regexp_replace({x}, r'{pattern}', '{to}')"

    def chars(self, x: str) -> str:
        return f"filter(split({x}, ''), c -> c <> '')"

    def slice(self, x: str, first: str, n: str) -> str:
        return f"slice({x}, {first}, {n})"

    def join(self, x: str, sep: str) -> str:
        return f"array_join({x}, '{sep}')"

    def explode(self, source: str, columns: str, array: str) -> str:
        """Rows (columns, pos from 0, item)."""
        return f"(SELECT {columns}, CAST(pos AS BIGINT) AS pos, item FROM {source} LATERAL VIEW posexplode({array}) AS pos, item)"

    def numbers(self, first: str, last: str, step: str) -> str:
        return f"sequence({first}, {last}, {step})"

    def dot(self, a: str, b: str) -> str:
        return f"aggregate(zip_with({a}, {b}, (x, y) -> CAST(x AS DOUBLE) * CAST(y AS DOUBLE)), 0D, (s, v) -> s + v)"

    def find(self, x: str, pattern: str) -> str:
        return f"regexp_extract_all({x}, r'{pattern}', 0)"

    def micros(self, x: str) -> str:
        return f"unix_micros(CAST({x} AS TIMESTAMP))"

    def json(self, x: str, key: str) -> str:
        return f"get_json_object({x}, '$.{key}')"

    def each(self, x: str, body: str) -> str:
        """``body`` for each item ``x`` at place ``i`` (from 1)."""
        return f"transform({x}, (x, j) -> {body.replace('{i}', '(j + 1)')})"

    def place(self, x: str, item: str) -> str:
        """Where the item first stands in an array (from 1; 0: nowhere)."""
        return f"CAST(array_position({x}, {item}) AS BIGINT)"

    def hex(self, x: str) -> str:
        return f"CAST(conv({x}, 16, 10) AS BIGINT)"

    def group(self, x: str, pattern: str, n: int) -> str:
        return f"regexp_extract({x}, r'{pattern}', {n})"

    def union(self, a: str, b: str) -> str:
        return f"array_sort(array_union({a}, {b}))"

    def intersect(self, a: str, b: str) -> str:
        return f"array_intersect({a}, {b})"

    def gather(self, x: str, by: str, sep: str) -> str:
        """Strings of a group, joined in order."""
        return f"array_join(transform(array_sort(collect_list(struct({by} AS k, {x} AS v))), s -> s.v), {sep})"

    def fixed(self, x: str) -> str:
        """Two decimals."""
        return f"format_string('%.2f', {x})"


class Oracle(Spark):
    """The SQL of the database that checks results."""

    def strip(self, x: str) -> str:
        return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"

    def words(self, x: str) -> str:
        return rf"list_filter(string_split_regex({x}, '\s+'), lambda w: w <> '')"

    def sentences(self, x: str) -> str:
        return f"string_split_regex({x}, '[.!?]+')"

    def letters(self, x: str) -> str:
        return rf"length(regexp_replace({x}, '[^\p{{L}}]', '', 'g'))"

    def size(self, x: str) -> str:
        return f"CAST(len({x}) AS BIGINT)"

    def distinct(self, x: str) -> str:
        return f"list_distinct({x})"

    def keep(self, x: str, var: str, test: str) -> str:
        return f"list_filter({x}, lambda {var}: {test})"

    def matches(self, x: str, pattern: str) -> str:
        return f"regexp_matches({x}, '{pattern}')"

    def replace_all(self, x: str, pattern: str, to: str) -> str:
        return f"regexp_replace({x}, '{pattern}', '{to}', 'g')"

    def chars(self, x: str) -> str:
        return f"list_filter(string_split({x}, ''), lambda c: c <> '')"

    def slice(self, x: str, first: str, n: str) -> str:
        return f"({x})[{first} : {first} + {n} - 1]"

    def join(self, x: str, sep: str) -> str:
        return f"array_to_string({x}, '{sep}')"

    def explode(self, source: str, columns: str, array: str) -> str:
        return f"(SELECT {columns}, CAST(generate_subscripts(a__, 1) - 1 AS BIGINT) AS pos, unnest(a__) AS item FROM (SELECT *, {array} AS a__ FROM {source}))"

    def numbers(self, first: str, last: str, step: str) -> str:
        return f"range({first}, {last} + 1, {step})"

    def dot(self, a: str, b: str) -> str:
        return f"list_inner_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"

    def find(self, x: str, pattern: str) -> str:
        return f"regexp_extract_all({x}, '{pattern}')"

    def micros(self, x: str) -> str:
        return f"epoch_us({x})"

    def json(self, x: str, key: str) -> str:
        return f"json_extract_string({x}, '$.{key}')"

    def each(self, x: str, body: str) -> str:
        return f"list_transform({x}, lambda x, i: {body.replace('{i}', 'i')})"

    def place(self, x: str, item: str) -> str:
        return f"CAST(coalesce(list_position({x}, {item}), 0) AS BIGINT)"

    def hex(self, x: str) -> str:
        return f"CAST(concat('0x', {x}) AS BIGINT)"

    def group(self, x: str, pattern: str, n: int) -> str:
        return f"regexp_extract({x}, '{pattern}', {n})"

    def union(self, a: str, b: str) -> str:
        return f"list_sort(list_distinct(list_concat({a}, {b})))"

    def intersect(self, a: str, b: str) -> str:
        return f"list_intersect({a}, {b})"

    def gather(self, x: str, by: str, sep: str) -> str:
        return f"string_agg({x}, {sep} ORDER BY {by})"

    def fixed(self, x: str) -> str:
        return f"printf('%.2f', {x})"
