"""Independent SQL for every checkable query, in the DuckDB dialect.

Tables ``documents`` etc. are views over the same Parquet files. Column names and types match the
Spark queries (INTEGER <-> int, BIGINT <-> bigint, DOUBLE <-> double, VARCHAR <-> string); doubles
are rounded to 6 digits on both sides. Regex notes: DuckDB uses RE2, whose ``\\s`` lacks ``\\x0B``,
so Java's ``\\s`` is spelled out as a class where it matters.
"""

from __future__ import annotations

from quire.functions import fixed_values as fv
from quire.operators.all_pairs import BOUNDS as ALL_PAIRS_BOUNDS
from quire.operators.network import DAMPING
from quire.sources.tables import headed_text_sql

PAGERANK_ROUNDS = 15  # of the registered query, on both sides
CORE_ROUNDS = 40  # of the twin; the query itself goes on until nothing changes

_WS = r"[\t\n\x0B\f\r ]"  # Java's \s
_CLEAN = r"[^a-zA-Z\t\n\x0B\f\r ]+"  # the cleaning rule with Java's \s spelled out


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _stop_list() -> str:
    return "[" + ", ".join(_lit(w) for w in fv.ENGLISH_STOP_WORDS) + "]"


HEADED = f"headed AS (SELECT doc_id, {headed_text_sql('duckdb')} AS text FROM documents)"

META = f"""meta AS (
  SELECT doc_id,
    nullif(regexp_extract(text, {_lit(fv.TITLE_PATTERN)}, 1), '') AS title,
    nullif(regexp_extract(text, {_lit(fv.AUTHOR_PATTERN)}, 1), '') AS author,
    cast(nullif(regexp_extract(regexp_extract(text, {_lit(fv.RELEASE_DATE_PATTERN)}, 1),
                               {_lit(fv.YEAR_IN_DATE_PATTERN)}, 1), '') AS INTEGER) AS year,
    nullif(regexp_extract(text, {_lit(fv.LANGUAGE_PATTERN)}, 1), '') AS language,
    nullif(regexp_extract(text, {_lit(fv.ENCODING_PATTERN)}, 1), '') AS encoding,
    regexp_extract(text, {_lit(fv.RELEASE_DATE_PATTERN)}, 1) AS release_date
  FROM headed)"""

AUTHOR_YEARS = f"""author_years AS (
  SELECT DISTINCT doc_id, author, year FROM (
    SELECT doc_id, regexp_extract(text, {_lit(fv.AUTHOR_PATTERN)}, 1) AS author,
      cast(nullif(regexp_extract(text, {_lit(fv.YEAR_IN_LINE_PATTERN)}, 1), '') AS INTEGER) AS year
    FROM headed)
  WHERE author <> '' AND year IS NOT NULL)"""


def _edges(window: int) -> str:
    return f"""ay AS (SELECT DISTINCT author, year FROM author_years),
edges AS (
  SELECT DISTINCT a.author AS influencer, b.author AS influenced
  FROM ay a JOIN ay b
    ON a.author <> b.author AND a.year < b.year AND b.year - a.year <= {int(window)})"""


DEGREES = """degrees AS (
  SELECT au.author,
    coalesce(i.n, 0)::BIGINT AS in_degree,
    coalesce(o.n, 0)::BIGINT AS out_degree
  FROM (SELECT DISTINCT author FROM author_years) au
  LEFT JOIN (SELECT influenced AS author, count(*) AS n FROM edges GROUP BY 1) i USING (author)
  LEFT JOIN (SELECT influencer AS author, count(*) AS n FROM edges GROUP BY 1) o USING (author))"""

# Tokenizer parity: clean, lower, split on single Java whitespace, drop trailing empties; a
# whitespace-only text has no tokens at all, an empty text has one empty token.
TOKENS = f"""cleaned AS (
  SELECT row_number() OVER () AS row_id, doc_id,
    lower(regexp_replace(coalesce(text, ''), '{_CLEAN}', ' ', 'g')) AS c
  FROM documents),
tok_arrays AS (
  SELECT row_id, doc_id,
    list_filter(
      CASE WHEN c <> '' AND regexp_full_match(c, '{_WS}+') THEN []::VARCHAR[]
           ELSE string_split_regex(regexp_replace(c, '{_WS}+$', ''), '{_WS}') END,
      lambda x: NOT list_contains({_stop_list()}, x)) AS toks
  FROM cleaned)"""

TFIDF = f"""{TOKENS},
tok_rows AS (SELECT doc_id, unnest(toks) AS term FROM tok_arrays),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok_rows WHERE term <> '' GROUP BY doc_id, term),
ndocs AS (SELECT count(*) AS n FROM documents),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (
  SELECT tf.doc_id, tf.term, tf.tf, ln((ndocs.n + 1.0) / (dfs.df + 1.0)) AS idf,
         tf.tf * ln((ndocs.n + 1.0) / (dfs.df + 1.0)) AS tfidf
  FROM tf JOIN dfs USING (term) CROSS JOIN ndocs)"""

SIMILAR = f"""{TFIDF},
target AS (SELECT min(doc_id) AS t FROM documents),
tv AS (SELECT term, tfidf AS tw FROM w WHERE doc_id = (SELECT t FROM target)),
tn AS (SELECT sqrt(sum(tw * tw)) AS tnorm FROM tv),
scored AS (
  SELECT w.doc_id, sqrt(sum(w.tfidf * w.tfidf)) AS norm, sum(w.tfidf * tv.tw) AS dot
  FROM w LEFT JOIN tv USING (term) GROUP BY w.doc_id),
sims AS (
  SELECT d.doc_id,
    round(coalesce(CASE WHEN s.norm * tn.tnorm > 0 THEN s.dot / (s.norm * tn.tnorm) END, 0.0), 6)
      AS similarity
  FROM documents d LEFT JOIN scored s ON d.doc_id IS NOT DISTINCT FROM s.doc_id CROSS JOIN tn
  WHERE d.doc_id IS DISTINCT FROM (SELECT t FROM target))"""

_TWO32 = 4294967296


def _rotl(x: str, r: int) -> str:
    return f"((({x})::HUGEINT * {1 << r}) % {_TWO32} + ({x}) // {1 << (32 - r)})"


def _mix(k: str) -> str:
    return f"(({_rotl(f'(({k})::HUGEINT * 3432918353) % {_TWO32}', 15)}::HUGEINT * 461845907) % {_TWO32})::UBIGINT"


# MurmurHash3 (x86, 32 bits, seed 42) of each distinct term's bytes, then a non-negative remainder:
# the bucket of HashingTF. Terms are ASCII letters, so ord() is the byte.
HASHED = f"""{TOKENS},
tok_all AS (SELECT row_id, doc_id, unnest(toks) AS term FROM tok_arrays),
term_bytes AS (
  SELECT term, length(term)::BIGINT AS n, CASE WHEN term = '' THEN []::UBIGINT[]
    ELSE list_transform(string_split(term, ''), lambda c: ord(c)::UBIGINT) END AS b
  FROM (SELECT DISTINCT term FROM tok_all)),
term_blocks AS (
  SELECT term, n, list_transform(range(0, n // 4), lambda i:
      {_mix('b[4*i+1] + b[4*i+2] * 256 + b[4*i+3] * 65536 + b[4*i+4] * 16777216')}) AS ks,
    coalesce(b[4*(n//4)+1], 0) + coalesce(b[4*(n//4)+2], 0) * 256 + coalesce(b[4*(n//4)+3], 0) * 65536 AS tail
  FROM term_bytes),
term_body AS (
  SELECT term, n, tail, list_reduce(list_prepend({fv.HASH_SEED}::UBIGINT, ks), lambda h, k:
      (({_rotl('xor(h, k)', 13)} * 5 + 3864292196) % {_TWO32})::UBIGINT) AS h FROM term_blocks),
f0 AS (SELECT term, xor(xor(h, {_mix('tail')}), n::UBIGINT) AS h FROM term_body),
f1 AS (SELECT term, ((xor(h, h // 65536)::HUGEINT * 2246822507) % {_TWO32})::UBIGINT AS h FROM f0),
f2 AS (SELECT term, ((xor(h, h // 8192)::HUGEINT * 3266489909) % {_TWO32})::UBIGINT AS h FROM f1),
f3 AS (SELECT term, xor(h, h // 65536)::BIGINT AS h FROM f2),
buckets AS (SELECT term, ((CASE WHEN h >= 2147483648 THEN h - {_TWO32} ELSE h END) % {fv.NUM_FEATURES}
    + {fv.NUM_FEATURES}) % {fv.NUM_FEATURES} AS bucket FROM f3),
htf AS (SELECT row_id, doc_id, bucket::INTEGER AS bucket, count(*)::DOUBLE AS tf
  FROM tok_all JOIN buckets USING (term) GROUP BY 1, 2, 3),
hdf AS (SELECT bucket, count(*) AS df FROM htf GROUP BY bucket),
hw AS (SELECT doc_id, bucket, tf * ln((n + 1.0) / (df + 1.0)) AS weight
  FROM htf JOIN hdf USING (bucket) CROSS JOIN (SELECT count(*) AS n FROM documents))"""

SIMILAR_HASHED = f"""{HASHED},
target AS (SELECT min(doc_id) AS t FROM documents),
tv AS (SELECT bucket, weight AS tw FROM hw WHERE doc_id = (SELECT t FROM target)),
tn AS (SELECT sqrt(sum(tw * tw)) AS tnorm FROM tv),
scored AS (
  SELECT hw.doc_id, sqrt(sum(hw.weight * hw.weight)) AS norm, sum(hw.weight * tv.tw) AS dot
  FROM hw LEFT JOIN tv USING (bucket) GROUP BY hw.doc_id),
sims AS (
  SELECT d.doc_id,
    round(coalesce(CASE WHEN s.norm * tn.tnorm > 0 THEN s.dot / (s.norm * tn.tnorm) END, 0.0), 6)
      AS similarity
  FROM documents d LEFT JOIN scored s ON d.doc_id IS NOT DISTINCT FROM s.doc_id CROSS JOIN tn
  WHERE d.doc_id IS DISTINCT FROM (SELECT t FROM target))"""


def _stats_select() -> str:
    cols = ("title", "author", "year", "language")
    parts = ["count(*) AS total_books"]
    parts += [f"count({c}) AS with_{c}" for c in cols]
    parts += [f"round(100.0 * count({c}) / nullif(count(*), 0), 4) AS pct_{c}" for c in cols]
    parts += ["min(year) AS min_year", "max(year) AS max_year"]
    return "SELECT " + ", ".join(parts) + " FROM meta"


def _counts(column: str, order: str, limit: int | None = None) -> str:
    order_by = f'"count" DESC, {column}' if order == "count" else column
    lim = f" LIMIT {limit}" if limit else ""
    return (f'SELECT {column}, count(*) AS "count" FROM meta WHERE {column} IS NOT NULL '
            f"GROUP BY {column} ORDER BY {order_by}{lim}")


STATS_KEYS = ("total_books", "with_title", "with_author", "with_year", "with_language",
              "pct_title", "pct_author", "pct_year", "pct_language", "min_year", "max_year")


def _metadata_report(top: int, authors: int, years: int) -> str:
    stats_rows = " UNION ALL ".join(
        f"SELECT 'stats' AS section, {i}::INTEGER AS rank, '{k}' AS key, {k}::DOUBLE AS value "
        f"FROM stats" for i, k in enumerate(STATS_KEYS, 1))
    tops = []
    for section, column, top in (("top_languages", "language", top), ("top_authors", "author", authors)):
        tops.append(
            f"SELECT '{section}' AS section, "
            f'row_number() OVER (ORDER BY "count" DESC, {column})::INTEGER AS rank, '
            f'{column} AS key, "count"::DOUBLE AS value FROM ({_counts(column, "count", top)})')
    tops.append(f"SELECT 'first_years' AS section, row_number() OVER (ORDER BY year)::INTEGER AS rank, "
                f'cast(year AS VARCHAR) AS key, "count"::DOUBLE AS value FROM ({_counts("year", "key", years)})')
    return (f"WITH {HEADED}, {META}, stats AS ({_stats_select()})\n"
            f"{stats_rows} UNION ALL {' UNION ALL '.join(tops)}")


def _network_summary(window: int) -> str:
    return f"""WITH {HEADED}, {AUTHOR_YEARS}, {_edges(window)}, {DEGREES}
SELECT 'books' AS metric, (SELECT count(*) FROM author_years)::DOUBLE AS value
UNION ALL SELECT 'authors', (SELECT count(*) FROM degrees)::DOUBLE
UNION ALL SELECT 'time_window', {int(window)}::DOUBLE
UNION ALL SELECT 'edges', (SELECT count(*) FROM edges)::DOUBLE
UNION ALL SELECT 'avg_out_degree', (SELECT round(avg(out_degree), 6) FROM degrees)::DOUBLE
UNION ALL SELECT 'avg_in_degree', (SELECT round(avg(in_degree), 6) FROM degrees)::DOUBLE"""


def _top_degree(column: str, k: int) -> str:
    return (f"SELECT author, in_degree, out_degree, "
            f"row_number() OVER (ORDER BY {column} DESC, author)::INTEGER AS rank FROM degrees "
            f"ORDER BY {column} DESC, author LIMIT {int(k)}")


# Every two documents that share a term: the cosine of their weights.
ALL_PAIRS = f"""{TFIDF},
norms AS (SELECT doc_id, sqrt(sum(tfidf * tfidf)) AS norm FROM w GROUP BY doc_id),
unit AS (SELECT w.doc_id, term, tfidf / norm AS x FROM w JOIN norms USING (doc_id) WHERE tfidf <> 0),
dots AS (
  SELECT a.doc_id, b.doc_id AS similar_doc_id, round(sum(a.x * b.x), 6) AS similarity
  FROM unit a JOIN unit b USING (term) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2)"""


def _most_similar(k: int, bound: float) -> str:
    return (f"WITH {ALL_PAIRS} SELECT doc_id, similar_doc_id, similarity, rank FROM (SELECT *, row_number() OVER ("
            "PARTITION BY doc_id ORDER BY similarity DESC, similar_doc_id)::INTEGER AS rank FROM dots "
            f"WHERE similarity > 0 AND similarity >= {bound}) WHERE rank <= {int(k)}")


def _pagerank(rounds: int, damping: float) -> str:
    steps = ["authors AS (SELECT DISTINCT author FROM author_years), total AS (SELECT count(*) AS n FROM authors)",
             "outs AS (SELECT influencer, count(*) AS d FROM edges GROUP BY 1)",
             "r0 AS MATERIALIZED (SELECT author, 1.0::DOUBLE / n AS r FROM authors, total)"]
    for i in range(1, rounds + 1):
        steps.append(f"""g{i} AS MATERIALIZED (
  SELECT a.author, {damping} * coalesce(sum(r.r / o.d), 0) AS got FROM authors a
  LEFT JOIN edges e ON e.influenced = a.author LEFT JOIN outs o ON o.influencer = e.influencer
  LEFT JOIN r{i - 1} r ON r.author = e.influencer GROUP BY 1),
r{i} AS MATERIALIZED (SELECT author, got + (1 - (SELECT sum(got) FROM g{i})) / n AS r FROM g{i}, total)""")
    return ", ".join(steps) + f" SELECT author, round(r * n, 6) AS pagerank FROM r{rounds}, total"


TRIANGLES = """both_ways AS (SELECT DISTINCT least(influencer, influenced) AS a, greatest(influencer, influenced) AS b FROM edges),
sides AS (SELECT a, b FROM both_ways UNION ALL SELECT b, a FROM both_ways),
near AS (SELECT a AS author, count(*) AS k FROM sides GROUP BY 1),
closed AS (
  SELECT x.a AS author, count(*) AS t FROM sides x JOIN sides y ON x.a = y.a AND x.b < y.b
  JOIN both_ways u ON u.a = x.b AND u.b = y.b GROUP BY 1)
SELECT au.author, coalesce(k, 0)::BIGINT AS neighbours, coalesce(t, 0)::BIGINT AS triangles,
  CASE WHEN coalesce(k, 0) > 1 THEN round(coalesce(t, 0) / (k * (k - 1) / 2.0), 6) ELSE 0.0 END AS clustering
FROM (SELECT DISTINCT author FROM author_years) au LEFT JOIN near USING (author) LEFT JOIN closed USING (author)"""

def _cores(rounds: int) -> str:
    """Peeling by the h-index of the neighbours, more rounds than the network needs."""
    steps = ["both_ways AS (SELECT DISTINCT least(influencer, influenced) AS a, greatest(influencer, influenced) AS b FROM edges)",
             "sides AS MATERIALIZED (SELECT a, b FROM both_ways UNION ALL SELECT b, a FROM both_ways)",
             "c0 AS MATERIALIZED (SELECT a AS author, count(*) AS core FROM sides GROUP BY 1)"]
    for i in range(1, rounds + 1):
        steps.append(f"""c{i} AS MATERIALIZED (SELECT author, max(least(core, place)) AS core FROM (
  SELECT s.a AS author, c.core, row_number() OVER (PARTITION BY s.a ORDER BY c.core DESC) AS place
  FROM sides s JOIN c{i - 1} c ON c.author = s.b) GROUP BY 1)""")
    return ", ".join(steps) + f""" SELECT au.author, coalesce(core, 0)::BIGINT AS core
FROM (SELECT DISTINCT author FROM author_years) au LEFT JOIN c{rounds} USING (author)"""


STRONG_COMPONENTS = """reach AS (
  SELECT influencer AS a, influenced AS b FROM edges
  UNION SELECT r.a, e.influenced FROM reach r JOIN edges e ON e.influencer = r.b),
named AS (
  SELECT au.author, least(au.author, coalesce(min(x.b), au.author)) AS component
  FROM (SELECT DISTINCT author FROM author_years) au
  LEFT JOIN (SELECT f.a, f.b FROM reach f JOIN reach g ON f.a = g.b AND f.b = g.a) x ON x.a = au.author GROUP BY au.author)
SELECT author, component, count(*) OVER (PARTITION BY component) AS size FROM named"""


def oracle_queries(window: int = fv.TIME_WINDOW, top_k: int = fv.TOP_K,
                   top_authors: int = fv.TOP_AUTHORS_LIMIT, report_top: int = fv.REPORT_TOP,
                   preview_rows: int = fv.PREVIEW_ROWS, num_books: int = fv.NUM_BOOKS) -> dict[str, str]:
    meta = f"WITH {HEADED}, {META} "
    net = f"WITH {HEADED}, {AUTHOR_YEARS}, {_edges(window)}, {DEGREES} "
    blank = "concat(chr(10), replace(text, chr(10), chr(10) || chr(10)))"
    assembled = (f"array_to_string(list_filter(string_split_regex(t, {_lit(fv.LINE_BREAK_PATTERN)}), "
                 "lambda x: x <> ''), chr(10))")
    return {
        # sources
        "assemble_lines": (f"SELECT doc_id, text FROM (SELECT doc_id, {assembled} AS text FROM "
                           f"(SELECT doc_id, {blank} AS t FROM documents)) WHERE text <> ''"),
        "preview_books": (f"SELECT doc_id, text FROM documents ORDER BY doc_id "
                          f"LIMIT {int(preview_rows)}"),
        "subset_documents": (f"SELECT doc_id, text FROM documents ORDER BY doc_id "
                             f"LIMIT {int(num_books)}"),
        # metadata profile
        "extract_metadata": meta + "SELECT doc_id, title, author, year, language, encoding, "
                                   "release_date FROM meta",
        "preview_metadata": meta + "SELECT doc_id, title, author, year, language, encoding, release_date "
                                   f"FROM meta ORDER BY doc_id LIMIT {fv.METADATA_PREVIEW_ROWS}",
        "metadata_stats": meta + _stats_select(),
        "books_per_year": meta + _counts("year", "key"),
        "language_distribution": meta + _counts("language", "count"),
        "encoding_distribution": meta + _counts("encoding", "count"),
        "top_authors": meta + _counts("author", "count", top_authors),
        "metadata_report": _metadata_report(report_top, top_authors, fv.REPORT_YEARS),
        # word count
        "word_count": ("SELECT word, count(*) AS \"count\" FROM (SELECT unnest(string_split_regex("
                       f"text, {_lit(fv.WORD_DELIMITERS)})) AS word FROM documents) WHERE word <> '' "
                       "GROUP BY word ORDER BY word"),
        # influence network
        "author_years": f"WITH {HEADED}, {AUTHOR_YEARS} SELECT doc_id, author, year FROM author_years",
        "influence_edges": net + "SELECT influencer, influenced FROM edges",
        "author_degrees": net + "SELECT author, in_degree, out_degree FROM degrees",
        "top_influential": net + _top_degree("out_degree", top_k),
        "top_influenced": net + _top_degree("in_degree", top_k),
        "network_summary": _network_summary(window),
        # text, TF-IDF, similarity
        "clean_text": ("SELECT doc_id, lower(regexp_replace(coalesce(text, ''), "
                       f"'{_CLEAN}', ' ', 'g')) AS clean_text FROM documents"),
        "tokenize": (f"WITH {TOKENS} SELECT doc_id, (generate_subscripts(toks, 1) - 1)::INTEGER "
                     f"AS pos, unnest(toks) AS token FROM tok_arrays"),
        "tfidf_terms": (f"WITH {TFIDF} SELECT doc_id, term, tf, round(idf, 6) AS idf, "
                        f"round(tfidf, 6) AS tfidf FROM w"),
        "similar_documents": f"WITH {SIMILAR} SELECT doc_id, similarity FROM sims",
        "similar_documents_topk": (
            f"WITH {SIMILAR} SELECT doc_id, similarity, "
            f"row_number() OVER (ORDER BY similarity DESC, doc_id)::INTEGER AS rank FROM sims "
            f"ORDER BY similarity DESC, doc_id LIMIT {int(top_k)}"),
        "tfidf_hashed": f"WITH {HASHED} SELECT doc_id, bucket, round(weight, 6) AS weight FROM hw",
        "similar_documents_hashed": f"WITH {SIMILAR_HASHED} SELECT doc_id, similarity FROM sims",
        "similarity_summary": (
            f"WITH {SIMILAR_HASHED} SELECT 'config' AS section, 1::INTEGER AS rank, 'books' AS key, "
            f"(SELECT count(*) FROM documents)::DOUBLE AS value UNION ALL SELECT 'config', 2, 'features', "
            f"{fv.NUM_FEATURES}::DOUBLE UNION ALL SELECT 'config', 3, (SELECT t FROM target)::VARCHAR, NULL "
            f"UNION ALL (SELECT 'top_similar', row_number() OVER (ORDER BY similarity DESC, doc_id)::INTEGER, "
            f"doc_id::VARCHAR, similarity FROM sims ORDER BY similarity DESC, doc_id LIMIT {int(top_k)})"),
        # every document against every other one
        "most_similar_documents": _most_similar(top_k, ALL_PAIRS_BOUNDS[-1]),
        "similarity_product": _most_similar(top_k, 0),
        # measures of the network
        "author_pagerank": net + ", " + _pagerank(PAGERANK_ROUNDS, DAMPING),
        "author_cores": net + ", " + _cores(CORE_ROUNDS),
        "author_triangles": net + ", " + TRIANGLES,
        "author_components": net.replace("WITH", "WITH RECURSIVE", 1) + ", " + STRONG_COMPONENTS,
    }
