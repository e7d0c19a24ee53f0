"""The registered queries in DuckDB SQL.

Where it can, the SQL takes another route than the library: phrases by substring of
the joined words, longest runs by trying every stretch of the query, proximity by a
position join, sets by list functions.
"""

from __future__ import annotations

from registry.queries import (
    BOOLEAN,
    EXTENDED,
    NESTED,
    PART_EXTENDED,
    PART_TEXTS,
    PHRASES_NESTED,
    TEXTS,
)

WORD = r"[\p{L}\p{N}]+"


def words(column: str) -> str:
    return f"regexp_extract_all(lower(coalesce({column}, '')), '{WORD}')"


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else str(value)


def _rows(rows: list[tuple], columns: str) -> str:
    listed = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {listed}) AS t({columns}))"


def queries_cte(rows: list[tuple]) -> str:
    """q: query_id, ql (words), comment; qt: query_id, term (distinct)."""
    return f"""q AS (SELECT query_id::BIGINT AS query_id, {words('text')} AS ql, comment
    FROM {_rows(rows, 'query_id, text, comment')}),
    qt AS (SELECT DISTINCT query_id, unnest(ql) AS term FROM q)"""


BENCHMARK = f"""q AS (SELECT item_id AS query_id, {words('text')} AS ql, 'item ' || item_id AS comment
    FROM benchmark),
    qt AS (SELECT DISTINCT query_id, unnest(ql) AS term FROM q)"""
Q = queries_cte(TEXTS)
PQ = queries_cte(PART_TEXTS)
W = f"w AS (SELECT doc_id, lang, source, n_chars, {words('text')} AS l FROM documents)"
PW = f"""w AS (SELECT p_partkey AS doc_id, {words('p_name')} AS l0, {words('p_brand')} AS l1,
    {words('p_type')} AS l2 FROM part)"""
TF = """tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(l) AS term FROM w)
    GROUP BY ALL)"""
BM = """st AS (SELECT count(*)::DOUBLE AS n, sum(len(l))::DOUBLE / count(*)::DOUBLE AS avg_len FROM w),
    dl AS (SELECT doc_id, len(l)::DOUBLE AS dl FROM w),
    df AS (SELECT term, count(*)::DOUBLE AS df FROM tf GROUP BY term),
    bm AS (SELECT query_id, doc_id, sum(CAST(round(ln(1.0::DOUBLE + (n - df + 0.5::DOUBLE)
        / (df + 0.5::DOUBLE)) * tf::DOUBLE * 2.2::DOUBLE / (tf::DOUBLE + 1.2::DOUBLE
        * (0.25::DOUBLE + 0.75::DOUBLE * dl / avg_len)) * 1000000::DOUBLE) AS BIGINT))::BIGINT AS bm25
    FROM qt JOIN tf USING (term) JOIN df USING (term) JOIN dl USING (doc_id), st GROUP BY ALL)"""
COUNTED = "cn AS (SELECT query_id, doc_id, sum(tf)::BIGINT AS weight FROM qt JOIN tf USING (term) GROUP BY ALL)"


def _padded(column: str) -> str:
    return f"(' ' || array_to_string({column}, ' ') || ' ')"


def _lcs(column: str) -> str:
    """Longest stretch of the query that occurs in the words: every stretch is tried."""
    stretches = """list_filter(flatten(list_transform(range(1, len(ql) + 1), lambda i:
        list_transform(range(i, len(ql) + 1), lambda j: ql[i:j]))), lambda s:
        contains(%s, %s))""" % (_padded(column), _padded("s"))
    return f"coalesce(list_max(list_transform({stretches}, lambda s: len(s))), 0)::BIGINT"


def _any(column: str = "l") -> str:
    return f"list_has_any({column}, ql)"


def _hits(column: str) -> str:
    return f"len(list_filter({column}, lambda x: list_contains(ql, x)))::BIGINT"


def _nterms(column: str) -> str:
    return f"len(list_intersect(list_distinct(ql), {column}))::BIGINT"


def _ranked(source: str, order: str, last: int, first: int = 0) -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {order})::INTEGER
    AS rank FROM {source}) WHERE rank > {first} AND rank <= {last}"""


MULTI = f"""{Q}, w AS (SELECT 'documents' AS index_name, doc_id, {words('text')} AS l FROM documents
    UNION ALL SELECT 'pages', page_id, {words('html')} FROM pages
    UNION ALL SELECT 'benchmark', item_id, {words('text')} FROM benchmark),
    cn AS (SELECT query_id, index_name, doc_id, {_hits('l')} AS weight FROM w, q WHERE {_any()})"""
SUPPLIERS = """os AS (SELECT l_orderkey AS doc_id, list_sort(list_distinct(list(l_suppkey))) AS suppliers
    FROM lineitem GROUP BY l_orderkey)"""
LABELLED = "documents LEFT JOIN labels USING (doc_id)"


def _group(key: str, source: str, extra: str = "", pair: str = "") -> str:
    second = f", {pair} AS group_key2" if pair else ""
    return f"""SELECT query_id, {key} AS group_key{second}, count(*) AS count, {extra}
    arg_min(doc_id, (-weight, doc_id)) AS best_doc_id, max(weight) AS best_weight
    FROM {source} GROUP BY query_id, {key}{', ' + pair if pair else ''}"""


ORDERS = """(SELECT 0::BIGINT AS query_id, o_orderkey AS doc_id, trunc(o_totalprice)::BIGINT AS weight,
    o_orderdate, o_custkey FROM orders)"""


SETTINGS = f"""asked AS (SELECT item_id AS query_id, CASE WHEN item_id % 11 <> 10 THEN text END AS text
    FROM benchmark),
    q AS (SELECT query_id, {words('text')} AS ql FROM asked WHERE text IS NOT NULL),
    qt AS (SELECT DISTINCT query_id, unnest(ql) AS term FROM q), {W}, {TF}, {BM},
    c AS (SELECT query_id, doc_id, sum(tf)::BIGINT AS hits, count(*) AS met FROM qt JOIN tf USING (term)
    GROUP BY ALL),
    m AS (SELECT query_id, doc_id, CASE WHEN query_id % 2 = 0 THEN bm25 ELSE hits END AS weight, lang,
    source, n_chars FROM c JOIN bm USING (query_id, doc_id) JOIN documents USING (doc_id)
    JOIN q USING (query_id) WHERE (query_id % 3 = 0 OR met = len(list_distinct(ql)))
    AND (query_id % 5 <> 0 OR n_chars BETWEEN 300 AND 3000))"""


def _boolean() -> str:
    """Each query as list conditions on the words of a document."""
    parts = []
    for query in sorted({row[0] for row in BOOLEAN}):
        conditions = []
        for _, _, kind, text in (row for row in BOOLEAN if row[0] == query):
            listed = "[" + ", ".join(f"'{t}'" for t in text.split()) + "]"
            has = "list_has_all" if kind == "must" else "list_has_any"
            conditions.append(f"{'NOT ' if kind == 'not' else ''}{has}(l, {listed})")
        parts.append(f"SELECT {query}::BIGINT AS query_id, doc_id FROM w WHERE {' AND '.join(conditions)}")
    return " UNION ALL ".join(parts)


def _clause(kind: str, op: str, n: int | None, columns: list[str], text: str) -> str:
    listed = "[" + ", ".join(f"'{t}'" for t in text.split()) + "]"
    joined = f"' {text} '"
    every = columns[0] if len(columns) == 1 else "(" + " || ".join(columns) + ")"
    if op == "words":
        return f"{'list_has_all' if kind == 'must' else 'list_has_any'}({every}, {listed})"
    if op == "quorum":
        return f"len(list_intersect({listed}, {every})) >= {n}"
    tests = {
        "phrase": lambda c: f"contains({_padded(c)}, {joined})",
        "start": lambda c: f"starts_with({_padded(c)}, {joined})",
        "end": lambda c: f"ends_with({_padded(c)}, {joined})",
        "near": lambda c: f"""len(list_filter(list_filter(range(1, len({c}) + 1),
            lambda i: list_contains({listed}, {c}[i])),
            lambda i: list_has_all({c}[i:i + {n} - 1], {listed}))) > 0""",
    }
    return "(" + " OR ".join(tests[op](c) for c in columns) + ")"


def _nested(rows: list[tuple]) -> str:
    """Each tree as one nested condition."""

    def condition(row: tuple, rows: list[tuple]) -> str:
        _, clause, _, kind, op, n, text = row
        if op == "group":
            members = [condition(r, rows) for r in rows if r[2] == clause]
            joined = "(" + (" AND " if kind == "must" else " OR ").join(members) + ")"
        else:
            joined = _clause(kind, op, n, ["l"], text)
        return f"(NOT {joined})" if kind == "not" else joined

    parts = []
    for query in sorted({row[0] for row in rows}):
        mine = [row for row in rows if row[0] == query]
        tops = " AND ".join(condition(row, mine) for row in mine if row[2] is None)
        parts.append(f"SELECT {query}::BIGINT AS query_id, doc_id FROM w WHERE {tops}")
    return " UNION ALL ".join(parts)


def _extended(rows: list[tuple], fields: dict[str, str]) -> str:
    parts = []
    for query in sorted({row[0] for row in rows}):
        conditions = []
        for _, _, kind, op, n, field, text in (row for row in rows if row[0] == query):
            columns = [fields[field]] if field else list(fields.values())
            test = _clause(kind, op, n, columns, text)
            conditions.append(f"NOT {test}" if kind == "not" else test)
        parts.append(f"SELECT {query}::BIGINT AS query_id, doc_id FROM w WHERE {' AND '.join(conditions)}")
    return " UNION ALL ".join(parts)


PART_FIELDS = {"p_name": "l0", "p_brand": "l1", "p_type": "l2"}
PANY = " OR ".join(f"list_has_any({c}, ql)" for c in PART_FIELDS.values())
PBM = f"""{PQ}, {PW}, v AS (SELECT doc_id, l0 || l1 || l2 AS l FROM w),
    {TF.replace('FROM w)', 'FROM v)')}, {BM.replace('FROM w)', 'FROM v)')}"""


def _boost(column: str) -> str:
    first = f"CASE WHEN {column}[1] = ql[1] THEN 2 ELSE 0 END"
    whole = f"CASE WHEN {column} = ql THEN 1 ELSE 0 END"
    return f"(4 * {_lcs(column)} + {first} + {whole})"


SEGMENTS = """CASE WHEN ts >= TIMESTAMP '2024-01-30 23:00:00' THEN 0
    WHEN ts >= TIMESTAMP '2024-01-30' THEN 1 WHEN ts >= TIMESTAMP '2024-01-24' THEN 2
    WHEN ts >= TIMESTAMP '2024-01-01' THEN 3 WHEN ts >= TIMESTAMP '2023-11-02' THEN 4 ELSE 5 END"""

UPDATES = """up AS (SELECT doc_id, quality * 1000 AS n_chars, 'checked' AS source FROM labels
    UNION ALL SELECT doc_id + 1000000000, quality * 1000, 'checked' FROM labels)"""

CONTENT = f"WITH {Q}, {W}, {TF}, {COUNTED}"
CARRIED = "(SELECT cn.*, lang, source, n_chars FROM cn JOIN documents USING (doc_id))"
STATUS_RULES = [
    ("offset_ < 0 OR offset_ >= 16777216", "error", "offset out of range"),
    ("limit_ < 1 OR limit_ >= 16777216", "error", "limit out of range"),
    ("mode > 6", "error", "unknown match mode"),
    ("ranker > 8", "error", "unknown ranker"),
    ("min_id > max_id", "error", "id range is reversed"),
    ("text IS NULL", "error", "query text is missing"),
    (f"len({words('text')}) = 0", "warning", "query has no words"),
]


def _status(i: int) -> str:
    cases = " ".join(f"WHEN {rule[0]} THEN '{rule[i]}'" for rule in STATUS_RULES)
    return f"CASE {cases} ELSE '{'ok' if i == 1 else ''}' END"


ORACLE: dict[str, str] = {
    "a1_corpus_scan": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "a2_multi_index": f"WITH {MULTI} SELECT * FROM cn",
    "a3_tokens": f"""WITH {W} SELECT doc_id, 'text' AS field,
        (unnest(range(len(l))))::INTEGER AS pos, unnest(l) AS term FROM w""",
    "a3_tokens_fields": f"WITH {PW} "
    + " UNION ALL ".join(
        f"""SELECT doc_id, '{f}' AS field, (unnest(range(len({c}))))::INTEGER AS pos,
        unnest({c}) AS term FROM w"""
        for f, c in PART_FIELDS.items()
    ),
    "a4_schema_listing": " UNION ALL ".join(
        f"""SELECT {i}::INTEGER AS position, '{role}' AS role, '{name}' AS name, '{kind}' AS type,
        count({name}) AS filled FROM documents"""
        for i, (role, name, kind) in enumerate(
            [
                ("field", "text", "string"),
                ("attribute", "lang", "string"),
                ("attribute", "source", "string"),
                ("attribute", "n_chars", "bigint"),
            ]
        )
    ),
    "a5_corpus_status": f"""WITH {W}, s AS (SELECT count(*) AS d, sum(len(l)) AS t FROM w),
        v AS (SELECT count(DISTINCT term) AS v FROM (SELECT unnest(l) AS term FROM w))
        SELECT 'documents' AS key, d::VARCHAR AS value FROM s
        UNION ALL SELECT 'tokens', t::VARCHAR FROM s
        UNION ALL SELECT 'distinct_terms', v::VARCHAR FROM v
        UNION ALL SELECT 'avg_length_milli', round(t::DOUBLE / d * 1000)::BIGINT::VARCHAR FROM s""",
    "b1_values_filter": """SELECT c_custkey, c_nationkey, c_acctbal FROM customer
        WHERE c_nationkey IN (1, 5, 7)""",
    "b1_values_filter_table": """SELECT c_custkey, c_nationkey, c_acctbal FROM customer
        WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)""",
    "b2_values_excluded": f"""SELECT doc_id, quality FROM {LABELLED}
        WHERE quality IS NULL OR quality <> 0""",
    "b2_values_table_excluded": f"""SELECT doc_id, quality FROM (SELECT * FROM {LABELLED}) AS d
        WHERE NOT EXISTS (SELECT 1 FROM labels b WHERE b.toxic = 0 AND b.quality = d.quality)""",
    "b3_range_filter": """SELECT p_partkey AS doc_id, p_size, p_retailprice FROM part
        WHERE p_size >= 10 AND p_size <= 20""",
    "b4_float_range_filter": """SELECT event_id, value FROM events
        WHERE value::FLOAT BETWEEN 10.1::FLOAT AND 20.1::FLOAT""",
    "b5_ranges_excluded": """SELECT p_partkey AS doc_id, p_size, p_retailprice FROM part
        WHERE (p_size < 10 OR p_size > 20)
        AND (p_retailprice::FLOAT < 950.5::FLOAT OR p_retailprice::FLOAT > 1000.5::FLOAT)""",
    "b6_id_range": """SELECT o_orderkey AS doc_id, o_custkey, o_orderstatus, o_totalprice, o_orderdate
        FROM orders WHERE o_orderkey BETWEEN 100 AND 5000""",
    "b6_id_range_open": """SELECT o_orderkey AS doc_id, o_custkey, o_orderstatus, o_totalprice,
        o_orderdate FROM orders WHERE o_orderkey >= 100""",
    "b7_conjunction": """SELECT o_orderkey AS doc_id, o_custkey, o_orderstatus, o_totalprice, o_orderdate
        FROM orders WHERE o_orderkey >= 100 AND o_custkey BETWEEN 10 AND 900
        AND o_totalprice::FLOAT BETWEEN 50000::FLOAT AND 200000::FLOAT AND o_custkey NOT IN (12, 13, 14)""",
    "b8_multi_value_filter": f"""WITH {SUPPLIERS} SELECT doc_id, suppliers FROM os
        WHERE list_has_any(suppliers, [3, 4, 5]) AND NOT list_has_any(suppliers, [1, 2])""",
    "b9_filter_scope": f"""WITH {Q}, {W}, m AS (SELECT query_id, n_chars FROM w, q WHERE {_any()}),
        s AS (SELECT 'short' AS scope, query_id FROM m WHERE n_chars <= 2000
        UNION ALL SELECT 'all', query_id FROM m), k AS (SELECT unnest(['short', 'all']) AS scope)
        SELECT k.scope, q.query_id, q.comment, least(count(s.query_id), 1000) AS total,
        count(s.query_id) AS total_found FROM q CROSS JOIN k
        LEFT JOIN s ON s.query_id = q.query_id AND s.scope = k.scope GROUP BY ALL""",
    "c1_all": f"WITH {Q}, {W} SELECT query_id, doc_id FROM w, q WHERE list_has_all(l, ql)",
    "c2_any": f"WITH {Q}, {W} SELECT query_id, doc_id FROM w, q WHERE {_any()}",
    "c3_phrase": f"""WITH {Q}, {W} SELECT query_id, doc_id FROM w, q
        WHERE contains({_padded('l')}, {_padded('ql')})""",
    "c3_phrase_benchmark": f"""WITH {BENCHMARK}, {W},
        p AS (SELECT doc_id, {_padded('l')} AS t FROM w), r AS (SELECT query_id, {_padded('ql')} AS s FROM q)
        SELECT query_id, doc_id FROM p, r WHERE contains(t, s)""",
    "c4_boolean": f"WITH {W} {_boolean()}",
    "c5_extended": f"WITH {W} {_extended(EXTENDED, {'text': 'l'})}",
    "c5_extended_fields": f"WITH {PW} {_extended(PART_EXTENDED, PART_FIELDS)}",
    "c6_fullscan": """SELECT 0::BIGINT AS query_id, o_orderkey AS doc_id, o_custkey, o_orderstatus,
        o_totalprice, o_orderdate, 1::BIGINT AS weight FROM orders""",
    "c7_extended2": f"""WITH {W}, m AS ({_extended(EXTENDED, {'text': 'l'})}),
        k AS (SELECT DISTINCT query_id::BIGINT AS query_id FROM
        {_rows([(r[0],) for r in EXTENDED], 'query_id')})
        SELECT k.query_id, least(count(m.doc_id), 1000) AS total, count(m.doc_id) AS total_found
        FROM k LEFT JOIN m USING (query_id) GROUP BY ALL""",
    "d1_proximity_bm25": f"""WITH {Q}, {W}, {TF}, {BM}, x AS (SELECT query_id, doc_id, {_lcs('l')} AS major
        FROM w, q WHERE {_any()})
        SELECT query_id, doc_id, major, least(bm25, 4294967295) AS minor,
        major * 4294967296 + least(bm25, 4294967295) AS weight FROM x JOIN bm USING (query_id, doc_id)""",
    "d2_bm25": f"WITH {Q}, {W}, {TF}, {BM} SELECT query_id, doc_id, bm25 AS weight FROM bm",
    "d2_bm25_benchmark": f"""WITH {BENCHMARK}, {W}, {TF}, {BM}
        SELECT query_id, doc_id, bm25 AS weight FROM bm""",
    "d3_none": f"WITH {Q}, {W} SELECT query_id, doc_id, 1::BIGINT AS weight FROM w, q WHERE {_any()}",
    "d4_wordcount": f"""WITH {Q}, {W} SELECT query_id, doc_id, {_hits('l')} AS weight
        FROM w, q WHERE {_any()}""",
    "d5_proximity": f"""WITH {Q}, {W} SELECT query_id, doc_id, {_lcs('l')} AS weight
        FROM w, q WHERE {_any()}""",
    "d6_matchany": f"""WITH {Q}, {W} SELECT query_id, doc_id,
        {_lcs('l')} * len(ql) + {_nterms('l')} AS weight FROM w, q WHERE {_any()}""",
    "d7_fieldmask": f"""WITH {PQ}, {PW} SELECT query_id, doc_id, (CASE WHEN list_has_any(l0, ql) THEN 1 ELSE 0 END
        + CASE WHEN list_has_any(l1, ql) THEN 2 ELSE 0 END
        + CASE WHEN list_has_any(l2, ql) THEN 4 ELSE 0 END)::BIGINT AS weight FROM w, q WHERE {PANY}""",
    "d8_boosted_proximity": f"""WITH {PBM}, x AS (SELECT query_id, doc_id,
        ({_boost('l0')} + {_boost('l1')} + {_boost('l2')})::BIGINT AS major FROM w, q WHERE {PANY})
        SELECT query_id, doc_id, major * 4294967296 + least(bm25, 4294967295) AS weight
        FROM x JOIN bm USING (query_id, doc_id)""",
    "d9_expr": f"""WITH {Q}, {W}, {TF}, {BM}, x AS (SELECT query_id, doc_id, 1000 * {_lcs('l')}
        + 10 * {_hits('l')} + {_nterms('l')} + 1 + len(l) AS rest FROM w, q WHERE {_any()})
        SELECT query_id, doc_id, bm25 + rest AS weight FROM x JOIN bm USING (query_id, doc_id)""",
    "d10_field_weights_name": f"""WITH {PQ}, {PW} SELECT query_id, doc_id,
        3 * {_hits('l0')} + {_hits('l1')} + 5 * {_hits('l2')} AS weight FROM w, q WHERE {PANY}""",
    "d11_field_weights_position": f"""WITH {PQ}, {PW} SELECT query_id, doc_id,
        3 * {_lcs('l0')} + {_lcs('l1')} + 5 * {_lcs('l2')} AS weight FROM w, q WHERE {PANY}""",
    "d12_index_weights": f"""WITH {MULTI} SELECT query_id, index_name, doc_id, weight
        * CASE index_name WHEN 'documents' THEN 2 WHEN 'pages' THEN 3 ELSE 1 END AS weight FROM cn""",
    "e1_relevance": f"""WITH {Q}, {W}, {TF}, {BM}, x AS (SELECT query_id, doc_id, bm25 AS weight FROM bm)
        {_ranked('x', 'weight DESC, doc_id', 20)}""",
    "e2_attr_desc": f"""{CONTENT}, x AS (SELECT query_id, doc_id, n_chars, weight FROM {CARRIED})
        {_ranked('x', 'n_chars DESC, doc_id', 20)}""",
    "e3_attr_asc": f"""{CONTENT}, x AS (SELECT query_id, doc_id, n_chars, weight FROM {CARRIED})
        {_ranked('x', 'n_chars, doc_id', 20)}""",
    "e4_time_segments": f"""WITH x AS (SELECT 0::BIGINT AS query_id, event_id AS doc_id, ts, value,
        trunc(value * 100)::BIGINT AS weight FROM events)
        {_ranked('x', f'{SEGMENTS}, weight DESC, doc_id', 500)}""",
    "e5_extended": f"""{CONTENT}, x AS (SELECT query_id, doc_id, lang, weight FROM {CARRIED})
        {_ranked('x', 'lang, weight DESC, doc_id DESC', 20)}""",
    "e6_expr": f"""{CONTENT}, x AS (SELECT query_id, doc_id, n_chars, weight FROM {CARRIED})
        {_ranked('x', 'weight * 100 - n_chars DESC, doc_id', 20)}""",
    "f1_offset_limit": f"{CONTENT} {_ranked('cn', 'weight DESC, doc_id', 25, 10)}",
    "f1_limit_2000": f"""SELECT * EXCLUDE (o_orderdate) FROM ({_ranked(
        '(SELECT s.query_id, doc_id, s.o_custkey, o_orderstatus, o_totalprice, s.o_orderdate, s.weight'
        f' FROM {ORDERS} s JOIN orders ON o_orderkey = doc_id)', 'weight DESC, doc_id', 2000)})""",
    "f2_max_matches": f"{CONTENT} {_ranked('cn', 'weight DESC, doc_id', 100)}",
    "f3_cutoff": f"""{CONTENT}, x AS ({_ranked('cn', 'doc_id', 50)})
        SELECT query_id, doc_id, weight FROM x""",
    "g1_day": _group("o_orderdate::DATE", ORDERS),
    "g1_day_seconds": _group("o_orderdate::DATE", ORDERS),
    "g8_group_search_sorted": f"""{CONTENT}, x AS (SELECT query_id, doc_id, lang, n_chars, weight,
        row_number() OVER (PARTITION BY query_id, lang ORDER BY n_chars DESC, doc_id) AS n,
        count(*) OVER (PARTITION BY query_id, lang) AS count FROM {CARRIED}),
        g AS (SELECT query_id, lang AS group_key, count, doc_id, weight, upper(lang) AS language,
        n_chars FROM x WHERE n = 1) {_ranked('g', 'group_key DESC', 20)}""",
    "g10_groups_2000": f"""WITH g AS ({_group('o_orderdate::DATE', ORDERS)})
        {_ranked('g', 'group_key DESC', 2000)}""",
    "j5_search_status": f"""WITH q AS (SELECT item_id AS query_id, CASE item_id % 3 WHEN 0 THEN text
        WHEN 1 THEN '...' END AS text FROM benchmark), k AS (SELECT query_id, text,
        coalesce({words('text')}, []) AS ql FROM q), {W},
        m AS (SELECT query_id FROM w, k WHERE {_any()})
        SELECT k.query_id, least(count(m.query_id), 1000) AS total, count(m.query_id) AS total_found,
        CASE WHEN text IS NULL THEN 'error' WHEN len(ql) = 0 THEN 'warning' ELSE 'ok' END AS status,
        CASE WHEN text IS NULL THEN 'query text is missing' WHEN len(ql) = 0 THEN 'query has no words'
        ELSE '' END AS message FROM k LEFT JOIN m USING (query_id) GROUP BY k.query_id, text, ql""",
    "b1_values_table_doubles": """SELECT p_partkey, price FROM (SELECT p_partkey,
        round(p_retailprice * 2) / 2 AS price FROM part)
        WHERE price IN (SELECT (p_partkey % 400 + 900)::DOUBLE FROM part)""",
    "b2_values_table_doubles": """SELECT p_partkey, price FROM (SELECT p_partkey,
        round(p_retailprice * 2) / 2 AS price FROM part)
        WHERE price NOT IN (SELECT (p_partkey % 400 + 900)::DOUBLE FROM part)""",
    "g2_week": _group("date_trunc('week', o_orderdate)::DATE", ORDERS),
    "g3_month": _group("date_trunc('month', o_orderdate)::DATE", ORDERS),
    "g4_year": _group("date_trunc('year', o_orderdate)::DATE", ORDERS),
    "g5_attr": f"{CONTENT} {_group('lang', CARRIED)}",
    "g6_attrpair": f"{CONTENT} {_group('lang', CARRIED, pair='source')}",
    "g7_multi_value": f"""WITH {SUPPLIERS}, x AS (SELECT 0::BIGINT AS query_id, doc_id, 1::BIGINT AS weight,
        unnest(suppliers) AS s FROM os) {_group('s', 'x')}""",
    "g8_group_best": f"""{CONTENT}, x AS (SELECT query_id, doc_id, lang, n_chars, weight,
        lang AS group_key, row_number() OVER (PARTITION BY query_id, lang ORDER BY n_chars DESC, doc_id) AS n,
        count(*) OVER (PARTITION BY query_id, lang) AS count FROM {CARRIED})
        SELECT * EXCLUDE (n) FROM x WHERE n = 1""",
    "g9_distinct": _group(
        "date_trunc('month', o_orderdate)::DATE", ORDERS, 'count(DISTINCT o_custkey) AS "distinct",'
    ),
    "g10_group_sort": f"""WITH g AS ({_group('o_orderdate::DATE', ORDERS)})
        {_ranked('g', 'count DESC, group_key DESC', 50)}""",
    "g10_group_search": f"""WITH {Q}, {W}, {TF}, {BM}, x AS (SELECT query_id, doc_id, bm25 AS weight, lang,
        source FROM bm JOIN documents USING (doc_id)),
        g AS ({_group('lang', 'x', 'count(DISTINCT source) AS "distinct",')})
        {_ranked('g', 'group_key DESC', 20)}""",
    "h1_select_list": """SELECT doc_id, upper(lang) AS language, n_chars // 1000 AS thousands, source
        FROM documents""",
    "h2_attribute_types": """SELECT p_partkey AS doc_id, p_size::BIGINT AS p_size,
        p_retailprice::FLOAT AS p_retailprice,
        TIMESTAMP '1970-01-01' + to_days(p_partkey::INTEGER) AS seconds FROM part""",
    "i1_override": f"""{CONTENT} SELECT query_id, cn.doc_id, weight, CASE WHEN query_id = 1 AND toxic = 1
        THEN quality * 1000 + 7 ELSE n_chars END::BIGINT AS n_chars
        FROM cn JOIN documents d USING (doc_id) LEFT JOIN labels b ON b.doc_id = cn.doc_id""",
    "i1_override_search": f"""{CONTENT}, x AS (SELECT query_id, cn.doc_id, weight, CASE WHEN query_id = 1
        AND toxic = 1 THEN 50 ELSE n_chars END::BIGINT AS n_chars, lang, source
        FROM cn JOIN documents d USING (doc_id) LEFT JOIN labels b ON b.doc_id = cn.doc_id),
        y AS (SELECT * FROM x WHERE n_chars <= 1000)
        {_ranked('y', 'n_chars, doc_id', 50)}""",
    "i2_update_scalar": f"""WITH {UPDATES} SELECT d.doc_id, lang, coalesce(up.source, d.source) AS source,
        coalesce(up.n_chars, d.n_chars) AS n_chars FROM documents d LEFT JOIN up USING (doc_id)""",
    "i3_update_multi_value": f"""WITH {SUPPLIERS} SELECT doc_id, CASE WHEN o_orderstatus = 'P'
        THEN o_custkey || ',0' ELSE array_to_string(suppliers, ',') END AS suppliers
        FROM os LEFT JOIN orders ON o_orderkey = doc_id""",
    "i4_updated_count": "SELECT count(*) AS updated FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "a3_index_postings": f"""WITH {W} SELECT doc_id, term, count(*)::INTEGER AS hits
        FROM (SELECT doc_id, unnest(l) AS term FROM w) GROUP BY ALL""",
    "c4_nested_groups": f"WITH {W} {_nested(NESTED)}",
    "c5_nested_groups": f"WITH {W} {_nested(PHRASES_NESTED)}",
    "d2_index_best": f"""WITH {BENCHMARK}, {W}, {TF}, {BM}, x AS (SELECT query_id, doc_id, bm25 AS weight
        FROM bm) {_ranked('x', 'weight DESC, doc_id', 20)}""",
    "f1_deep_page": f"""SELECT query_id, doc_id, weight, rank FROM
        ({_ranked(ORDERS, 'weight DESC, doc_id', 7500, 7000)})""",
    "i2_update_log": """SELECT d.doc_id, CASE WHEN d.doc_id % 3 = 0 THEN
        CASE WHEN d.doc_id % 2 = 0 THEN 'xx' END ELSE lang END AS lang,
        CASE WHEN d.doc_id % 3 = 0 THEN 'moved' ELSE source END AS source,
        CASE WHEN f.doc_id IS NOT NULL THEN f.doc_id WHEN b.doc_id IS NOT NULL THEN b.quality
        ELSE n_chars END::BIGINT AS n_chars
        FROM documents d LEFT JOIN labels b ON b.doc_id = d.doc_id
        LEFT JOIN (SELECT doc_id FROM documents WHERE doc_id % 4 = 0) f ON f.doc_id + 10 = d.doc_id""",
    "i4_update_log_counts": """SELECT 1 AS batch, count(*) AS updated FROM documents
        WHERE doc_id IN (SELECT doc_id FROM labels)
        UNION ALL SELECT 2, count(*) FROM documents WHERE doc_id % 3 = 0
        UNION ALL SELECT 3, count(*) FROM documents WHERE doc_id - 10 IN (SELECT doc_id FROM documents
        WHERE doc_id % 4 = 0)""",
    "j1_index_filtered": f"""WITH {BENCHMARK}, {W}, {TF}, {BM}, x AS (SELECT query_id, doc_id,
        bm25 AS weight, lang, source, n_chars FROM bm JOIN documents USING (doc_id)
        WHERE n_chars BETWEEN 500 AND 5000) {_ranked('x', 'weight DESC, doc_id', 20)}""",
    "j1_settings_per_query": f"""WITH {SETTINGS}
        SELECT query_id, doc_id, weight, lang, source, n_chars, rank FROM (SELECT *, row_number() OVER
        (PARTITION BY query_id ORDER BY CASE WHEN query_id % 6 = 3 THEN n_chars END NULLS LAST,
        CASE WHEN query_id % 6 <> 3 THEN weight END DESC, doc_id)::INTEGER AS rank FROM m)
        WHERE rank > query_id % 4 AND rank <= query_id % 4 + 20""",
    "j4_index_word_stats": f"""WITH {Q}, {W}, {TF} SELECT query_id, term AS word, count(tf) AS docs,
        coalesce(sum(tf), 0)::BIGINT AS hits FROM qt LEFT JOIN tf USING (term) GROUP BY ALL""",
    "j5_settings_summary": f"""WITH {SETTINGS} SELECT a.query_id, least(count(m.query_id), 1000) AS total,
        count(m.query_id) AS total_found, CASE WHEN text IS NULL THEN 'error' ELSE 'ok' END AS status,
        CASE WHEN text IS NULL THEN 'query text is missing' ELSE '' END AS message, '' AS comment
        FROM asked a LEFT JOIN m USING (query_id) GROUP BY a.query_id, text""",
    "j1_batch_search": f"""WITH {BENCHMARK}, {W}, {TF}, {BM}, x AS (SELECT query_id, doc_id, bm25 AS weight,
        lang, source, n_chars FROM bm JOIN documents USING (doc_id))
        {_ranked('x', 'weight DESC, doc_id', 20)}""",
    "j1_default_search": f"""WITH {Q}, {W}, {TF}, {BM}, m AS (SELECT query_id, doc_id, lang, source, n_chars,
        {_lcs('l')} AS lcs FROM w, q WHERE list_has_all(l, ql)),
        x AS (SELECT query_id, doc_id, lcs * 4294967296 + least(bm25, 4294967295) AS weight, lang,
        source, n_chars FROM m JOIN bm USING (query_id, doc_id))
        {_ranked('x', 'weight DESC, doc_id', 20)}""",
    "j2_match_result": f"""{CONTENT}, x AS (SELECT * FROM {CARRIED})
        {_ranked('x', 'weight DESC, doc_id', 20)}""",
    "j3_totals": f"""WITH {Q}, {W}, m AS (SELECT query_id FROM w, q WHERE list_has_all(l, ql))
        SELECT q.query_id, least(count(m.query_id), 500) AS total, count(m.query_id) AS total_found
        FROM q LEFT JOIN m USING (query_id) GROUP BY q.query_id""",
    "j4_word_stats": f"""WITH {Q}, {W}, {TF} SELECT query_id, term AS word, count(tf) AS docs,
        coalesce(sum(tf), 0)::BIGINT AS hits FROM qt LEFT JOIN tf USING (term) GROUP BY ALL""",
    "j5_query_status": f"""WITH g AS (SELECT conv_id * 1000 + turn AS query_id,
        CASE WHEN role <> 'system' THEN text ELSE '...' END AS text, conv_id % 9 AS mode,
        turn % 11 AS ranker, conv_id % 50 - 2 AS offset_, turn * 4000000 AS limit_, turn AS min_id,
        conv_id % 7 AS max_id FROM conversations)
        SELECT query_id, {_status(1)} AS status, {_status(2)} AS message FROM g""",
    "j6_query_comment": f"""WITH {BENCHMARK}, {W}, m AS (SELECT query_id FROM w, q WHERE {_any()})
        SELECT q.query_id, least(count(m.query_id), 1000) AS total, count(m.query_id) AS total_found,
        comment FROM q LEFT JOIN m USING (query_id) GROUP BY q.query_id, comment""",
    "k1_escape_text": r"""SELECT page_id, regexp_replace(html, '([=()|\-!@~"&/\\^$])', '\\\1', 'g')
        AS escaped FROM pages""",
    "l1_keywords": f"""WITH {BENCHMARK}, {W}, {TF}, n AS (SELECT term, count(*) AS docs, sum(tf)::BIGINT AS hits
        FROM tf GROUP BY term), p AS (SELECT query_id, (unnest(range(len(ql))))::INTEGER AS qpos,
        unnest(ql) AS term FROM q)
        SELECT query_id, qpos, term, coalesce(docs, 0) AS docs, coalesce(hits, 0) AS hits
        FROM p LEFT JOIN n USING (term)""",
    "l2_excerpts": f"""{CONTENT}, r AS ({_ranked('cn', 'weight DESC, doc_id', 20)}),
        x AS (SELECT query_id, doc_id, l, list_min(list_filter(list_transform(list_distinct(ql),
        lambda t: list_position(l, t)), lambda p: p > 0)) AS p
        FROM r JOIN w USING (doc_id) JOIN q USING (query_id))
        SELECT query_id, doc_id, 'text' AS field, (p - 1)::INTEGER AS pos,
        array_to_string(l[greatest(p - 5, 1):p + 5], ' ') AS excerpt FROM x""",
}
ORACLE["j1_index_search"] = ORACLE["j1_default_search"]
