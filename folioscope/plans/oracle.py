"""For each query with an exact SQL counterpart, that SQL, for checking results in DuckDB.

Written from the meaning of each operator, not from its Spark code, over the
same views the queries start from.
"""

from folioscope.plans.views import view_ctes

# Spark's default English stop words.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()

ORACLE: dict[str, str] = {}


def _sql(views: str, body: str, *ctes: str) -> str:
    parts = [*view_ctes(*views.split()), *ctes]
    prefix = "WITH " + ",\n".join(parts) + "\n" if parts else ""
    return prefix + body.strip()


# Enriched articles: an independent statement of dates, author counts and the join.
DATE = """CAST(try_strptime(
    CASE WHEN contains(id, '/') AND substring(split_part(id, '/', 2), 1, 2) >= '90'
              THEN '19' || substring(split_part(id, '/', 2), 1, 4)
         WHEN contains(id, '/') THEN '20' || substring(split_part(id, '/', 2), 1, 4)
         ELSE '20' || substring(id, 1, 4) END, '%Y%m') AS DATE)"""
AUTHORS = "CAST(len(string_split(replace(authors, ' and ', ','), ',')) AS INTEGER)"
TEXT = "concat_ws(' ', title, abstract)"
BUCKET = "(CAST('0x' || substring(md5(id), 1, 8) AS BIGINT) % 100)"

ENRICHED = f"""enriched AS (
    SELECT id, {TEXT} AS text, title, abstract, coalesce({AUTHORS}, -1) AS authers_num,
           {DATE} AS article_date, main_category, description AS main_topic
    FROM articles JOIN taxonomy ON split_part(category, ' ', 1) = sub_category)"""


def _enriched(body: str) -> str:
    return _sql("articles taxonomy", body, ENRICHED)


# --- sources and sinks ---------------------------------------------------------------------


def _scan(key: str, skip: int) -> str:
    at = f"strpos(body, '\"{key}\"')"
    rest = f"substring(body, {at} + {len(key) + 2 + skip})"
    return f"""CASE WHEN {at} = 0 THEN 'None'
                    WHEN strpos({rest}, '"') = 0 THEN substring({rest}, 1, greatest(length({rest}) - 1, 0))
                    ELSE substring({rest}, 1, strpos({rest}, '"') - 1) END"""


SCANNED = f"""scanned AS (
    SELECT {_scan("id", 2)} AS id, {_scan("authors", 2)} AS authors, {_scan("title", 2)} AS title,
           {_scan("abstract", 3)} AS abstract, {_scan("journal_ref", 3)} AS journal_ref,
           {_scan("categories", 2)} AS category, {_scan("update_date", 2)} AS update_date
    FROM (SELECT substring(trim(value), 2, length(trim(value)) - 2) AS body FROM raw_lines) b)"""
FLAT = (
    "id || '::' || authors || '::' || title || '::' || abstract || '::' || journal_ref"
    " || '::' || category || '::' || update_date"
)

ORACLE["json_line_extract"] = _sql("raw_lines", "SELECT * FROM scanned", SCANNED)
ORACLE["json_line_parse"] = _sql(
    "articles",
    """
SELECT id, authors, title, '  ' || abstract AS abstract,
       CASE doc_id % 4 WHEN 1 THEN 'J. Test 1 (2001) 5' WHEN 2 THEN ' Old J. 7' END AS journal_ref,
       category, substring(update_date, 1, 10) AS update_date
FROM articles""",
)
ORACLE["record_flatten"] = _sql("raw_lines", f"SELECT {FLAT} AS value FROM scanned", SCANNED)
ORACLE["convert_parsed"] = _sql(
    "broken_titles",
    "SELECT "
    + ", ".join(
        f"nullif(replace(regexp_replace({c}, '[\\r\\n]+', ' ', 'g'), '::', ': :'), '') AS {c}"
        for c in "id authors title abstract journal_ref category update_date".split()
    )
    + " FROM broken_titles",
)
ORACLE["text_sink"] = ORACLE["record_flatten"]
ORACLE["delimited_scan"] = _sql(
    "raw_lines",
    """
SELECT nullif(id, '') AS id, nullif(authors, '') AS authors, nullif(title, '') AS title,
       nullif(abstract, '') AS abstract, nullif(journal_ref, '') AS journal_ref,
       nullif(category, '') AS category, nullif(update_date, '') AS update_date
FROM scanned""",
    SCANNED,
)
ORACLE["delimited_scan_broken"] = _sql(
    "articles",
    "SELECT "
    + ", ".join(f"nullif({c}, '') AS {c}" for c in "id authors title abstract journal_ref category update_date".split())
    + " FROM articles",
)
ORACLE["glob_scan"] = _sql(
    "articles", 'SELECT category, count(*) AS "count" FROM articles GROUP BY category'
)
ORACLE["header_csv_scan"] = _sql(
    "articles",
    """
SELECT CAST(doc_id AS INTEGER) AS doc_id, id, authors, category, lang FROM articles""",
)
ORACLE["header_csv_long_text"] = _sql(
    "articles",
    """
SELECT doc_id, nullif(concat_ws(chr(10) || '"a, b"' || chr(10), title, abstract), '') AS abstract FROM articles""",
)
ORACLE["html_taxonomy_extract"] = _sql(
    "taxonomy_parts",
    """
SELECT page_id, code AS sub_category, 'Topics & Methods (' || page_id AS description
FROM taxonomy_parts
UNION ALL
SELECT page_id, code || 'x', NULL FROM taxonomy_parts
UNION ALL
SELECT page_id, code || '.y', 'Café & – ' || url || ' &lt;' FROM taxonomy_parts""",
)
ORACLE["taxonomy_bucket"] = _sql(
    "taxonomy_parts",
    """
SELECT main_name AS main_category, code AS sub_category, 'Topics & Methods (' || page_id AS description
FROM taxonomy_parts
UNION ALL
SELECT main_name, code || 'x', NULL FROM taxonomy_parts
UNION ALL
SELECT main_name, code || '.y', 'Café & – ' || url || ' &lt;' FROM taxonomy_parts""",
)
_ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")]


def _plain(markup: str) -> str:
    text = f"regexp_replace({markup}, '<[^>]*>', '', 'g')"
    for entity, char in _ENTITIES:
        text = f"replace({text}, '{entity}', '{char}')"
    return text


_LINK = """'(?is)<a\\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>'"""
ORACLE["page_links"] = f"""
SELECT page_id, href, {_plain("label")} AS label
FROM (SELECT page_id, unnest(regexp_extract_all(html, {_LINK}, 1)) AS href,
             unnest(regexp_extract_all(html, {_LINK}, 2)) AS label
      FROM pages) l"""
ORACLE["page_headings"] = f"""
SELECT page_id, {_plain("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} AS heading FROM pages"""
ORACLE["main_category_rows"] = _sql(
    "taxonomy_parts",
    """
SELECT page_id, main_name AS main_category, 'ArXiv' AS sub_category, '' AS description
FROM taxonomy_parts""",
)

MAIN_NAME = """CASE split_part(coalesce(category, ''), '.', 1)
            WHEN 'cs' THEN 'Computer Science' WHEN 'econ' THEN 'Economics'
            WHEN 'eess' THEN 'Electrical Engineering and Systems Science'
            WHEN 'math' THEN 'Mathematics' WHEN 'q-bio' THEN 'Quantitative Biology'
            WHEN 'q-fin' THEN 'Quantitative Finance' WHEN 'stat' THEN 'Statistics'
            ELSE 'Physics' END"""
ORACLE["local_rows_source"] = _sql(
    "coded_articles", f"SELECT id, {MAIN_NAME} AS main_category FROM coded_articles"
)
ORACLE["table_write"] = _enriched("SELECT * FROM enriched")
ORACLE["table_scan"] = _enriched("SELECT id, main_topic FROM enriched")
ORACLE["write_if_absent"] = _sql("articles", "SELECT id, category FROM articles")
ORACLE["partitioned_write"] = _enriched(
    "SELECT id, authers_num, main_topic, main_category FROM enriched"
)


def _merged(inserted_title: str) -> str:
    return _sql(
        "stored_predictions new_predictions",
        f"""
SELECT coalesce(t.id, u.id) AS id,
       CASE WHEN t.in_target THEN t.title ELSE {inserted_title} END AS title,
       CASE WHEN t.in_target THEN t.main_category ELSE u.main_category END AS main_category,
       CASE WHEN u.in_updates THEN u.label ELSE t.label END AS label,
       CASE WHEN u.in_updates THEN u.prediction ELSE t.prediction END AS prediction
FROM (SELECT *, true AS in_target FROM stored_predictions) t
FULL OUTER JOIN (SELECT *, true AS in_updates FROM new_predictions) u ON t.id = u.id""",
    )


ORACLE["upsert"] = _merged("NULL")
ORACLE["upsert_folders"] = ORACLE["upsert"]
ORACLE["upsert_insert_all"] = _merged("u.title")

# --- projections and filters ---------------------------------------------------------------

ORACLE["rename_positional"] = _sql(
    "articles",
    "SELECT id, authors, title, abstract, journal_ref, category, update_date FROM articles",
)
ORACLE["project"] = _sql(
    "articles taxonomy",
    """
SELECT id, category, main_category, description AS main_topic
FROM articles JOIN taxonomy ON split_part(category, ' ', 1) = sub_category""",
)
ORACLE["derive_column"] = _sql(
    "articles",
    """
SELECT id, split_part(category, ' ', 1) AS category1,
       replace(update_date, chr(9), '') AS update_date
FROM articles""",
)
ORACLE["drop_column"] = _sql(
    "articles",
    "SELECT id, authors, journal_ref, category, update_date, doc_id, lang FROM articles",
)
ORACLE["filter_is_null"] = _sql(
    "articles", "SELECT id, title, authors FROM articles WHERE title IS NULL"
)
ORACLE["predicate_contains"] = _sql(
    "articles", "SELECT id, category FROM articles WHERE contains(id, '/')"
)
ORACLE["predicate_compare"] = _sql(
    "articles",
    """
SELECT id, substring(split_part(id, '/', 2), 1, 2) AS yy FROM articles
WHERE contains(id, '/') AND substring(split_part(id, '/', 2), 1, 2) >= '90'""",
)

# --- joins ---------------------------------------------------------------------------------

ORACLE["taxonomy_join"] = _sql(
    "articles taxonomy",
    """
SELECT id, authors, title, abstract, category, update_date, doc_id, lang, main_category,
       description AS main_topic
FROM articles JOIN taxonomy ON split_part(category, ' ', 1) = sub_category""",
)
ORACLE["taxonomy_join_broadcast"] = ORACLE["taxonomy_join"]
ORACLE["taxonomy_join_salted"] = ORACLE["taxonomy_join"]
ORACLE["taxonomy_unmatched"] = _sql(
    "articles taxonomy",
    """
SELECT id, category FROM articles
WHERE split_part(category, ' ', 1) NOT IN (SELECT sub_category FROM taxonomy)""",
)
ORACLE["merge_match"] = _sql(
    "stored_predictions new_predictions",
    """
SELECT t.id, t.prediction, u.prediction AS new_prediction
FROM stored_predictions t JOIN new_predictions u ON t.id = u.id""",
)

# --- aggregations, sorts -------------------------------------------------------------------

YEAR = "CAST(year(article_date) AS INTEGER)"
YEARLY = f"""
SELECT main_category, {YEAR} AS article_year, round(avg(authers_num), 0) AS avg_authors,
       %s max(authers_num) AS max_authors
FROM enriched GROUP BY ALL"""
ORACLE["filter_eq"] = _enriched(f"SELECT * FROM ({YEARLY % ''}) s WHERE main_category = 'ASIA'")
ORACLE["count_by_category"] = _enriched(
    'SELECT main_category, count(*) AS "count" FROM enriched GROUP BY main_category'
)
ORACLE["topic_counts"] = _enriched(
    'SELECT main_topic, count(*) AS "count" FROM enriched GROUP BY main_topic'
)
ORACLE["count_by_year_category"] = _enriched(
    f'SELECT {YEAR} AS "year", main_category, count(*) AS "count" FROM enriched GROUP BY ALL'
)
ORACLE["author_stats_by_year"] = _enriched(YEARLY % "")
ORACLE["author_stats_by_year_min"] = _enriched(YEARLY % "min(authers_num) AS min_authors,")
ORACLE["author_stats_by_category"] = _enriched(
    """
SELECT main_category, round(avg(authers_num), 0) AS avg_authors, max(authers_num) AS max_authors
FROM enriched GROUP BY main_category"""
)
ORACLE["max_of_max"] = _enriched(
    "SELECT main_category, max(authers_num) AS max_authors FROM enriched GROUP BY main_category"
)
ORACLE["row_count"] = "SELECT count(*) AS rows FROM events"
ORACLE["null_profile"] = _sql(
    "articles",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM articles"
        for c in "id authors title abstract journal_ref category update_date doc_id lang".split()
    ),
)
ORACLE["null_date_count"] = _sql(
    "articles", f"SELECT count(*) AS null_count FROM articles WHERE {DATE} IS NULL"
)
ORACLE["dedupe_by_id"] = _sql(
    "revisions",
    """
SELECT id, title, category, update_date, doc_id
FROM (SELECT *, row_number() OVER (PARTITION BY id
                                   ORDER BY update_date NULLS FIRST, title NULLS FIRST,
                                            category NULLS FIRST, doc_id NULLS FIRST) AS place
      FROM revisions) r
WHERE place = 1""",
)
ORACLE["dedupe_by_id_shuffled"] = ORACLE["dedupe_by_id"]
ORACLE["sort_mixed"] = _sql(
    "articles",
    """
SELECT *, CAST(row_number() OVER (ORDER BY lang, "count" DESC, code) AS INTEGER) AS position
FROM (SELECT lang, split_part(category, ' ', 1) AS code, count(*) AS "count" FROM articles GROUP BY ALL) c""",
)
ORACLE["sort_multi"] = _enriched(
    """
SELECT *, CAST(row_number() OVER (ORDER BY main_category, main_topic) AS INTEGER) AS position
FROM (SELECT main_category, main_topic, round(avg(authers_num), 0) AS avg_authors, max(authers_num) AS max_authors
      FROM enriched GROUP BY ALL) s"""
)
ORACLE["sort_desc_pandas"] = _enriched(
    """
SELECT *, CAST(row_number() OVER (ORDER BY max_authors DESC, avg_authors DESC, main_category) AS INTEGER) AS position
FROM (SELECT main_category, round(avg(authers_num), 0) AS avg_authors, max(authers_num) AS max_authors
      FROM enriched GROUP BY main_category) s"""
)
ORACLE["top_k"] = _enriched(
    """
SELECT *, CAST(row_number() OVER (ORDER BY "count" DESC, main_topic) AS INTEGER) AS position
FROM (SELECT main_topic, count(*) AS "count" FROM enriched GROUP BY main_topic) t
ORDER BY position LIMIT 10"""
)
ORACLE["category_series"] = _enriched(
    f"""
SELECT e.main_category, t.category_total, {YEAR} AS "year", count(*) AS "count"
FROM enriched e
JOIN (SELECT main_category, count(*) AS category_total FROM enriched GROUP BY main_category) t
  ON e.main_category = t.main_category
GROUP BY ALL"""
)

# --- scalar functions ----------------------------------------------------------------------

ORACLE["primary_category"] = _sql(
    "coded_articles", "SELECT id, split_part(category, ' ', 1) AS category1 FROM coded_articles"
)
ORACLE["category_case"] = _sql(
    "coded_articles",
    f"""
SELECT id, replace(lower({MAIN_NAME}), ' and systems science', '') AS short_name,
       lower({MAIN_NAME}) AS long_name
FROM coded_articles""",
)
ORACLE["category_shorten"] = _sql(
    "coded_articles",
    f"SELECT id, replace({MAIN_NAME}, ' and Systems Science', '') AS main_category FROM coded_articles",
)
ORACLE["article_date"] = _sql("articles", f"SELECT id, {DATE} AS article_date FROM articles")
ORACLE["article_year"] = _sql(
    "articles", f'SELECT id, CAST(year({DATE}) AS INTEGER) AS "year" FROM articles'
)
ORACLE["update_date_clean"] = _sql(
    "articles", "SELECT id, replace(update_date, chr(9), '') AS update_date FROM articles"
)
ORACLE["author_count"] = _sql(
    "articles",
    f"""
SELECT id, {AUTHORS} AS authers_num, coalesce({AUTHORS}, -1) AS authers_num_filled,
       CAST(len(list_filter(string_split(replace(replace(authors, ', and ', ','), ' and ', ','), ','),
                            lambda n: trim(n) <> '')) AS INTEGER) AS authers_num_clean
FROM articles""",
)
ORACLE["text_concat"] = _sql("articles", f"SELECT id, {TEXT} AS text FROM articles")
ORACLE["round_avg"] = _sql(
    "articles",
    f"SELECT lang, round(avg(coalesce({AUTHORS}, -1)), 0) AS avg_authors FROM articles GROUP BY lang",
)
ORACLE["strip_parens"] = _sql(
    "articles", "SELECT id, trim('((' || title || ' (x))', '()') AS stripped FROM articles"
)

# --- splits --------------------------------------------------------------------------------

ORACLE["split_train"] = _sql("articles", f"SELECT id, category FROM articles WHERE {BUCKET} < 80")


def _parts(*edges: tuple[str, int]) -> str:
    return _sql(
        "articles",
        " UNION ALL ".join(
            f"SELECT id, category, '{part}' AS part FROM articles WHERE {BUCKET} >= {edge}"
            for part, edge in edges
        ),
    )


ORACLE["split_tests"] = _parts(("test1", 50), ("test2", 40), ("test3", 30))
ORACLE["split_tests_disjoint"] = _parts(("test1", 90), ("test2", 88), ("test3", 86))
ORACLE["split_ratio"] = _sql(
    "articles",
    f"""
SELECT id, category, CASE WHEN {BUCKET} < 70 THEN 'train' ELSE 'test' END AS part FROM articles""",
)

ORACLE["random_split"] = "SELECT count(*) AS rows_total, 0::BIGINT AS rows_in_both, 0::BIGINT AS rows_in_neither FROM documents"

# --- features ------------------------------------------------------------------------------

ORACLE["label_index"] = _enriched(
    """
SELECT id, e.main_category, label
FROM enriched e
JOIN (SELECT main_category,
             CAST(row_number() OVER (ORDER BY count(*) DESC, main_category) - 1 AS DOUBLE) AS label
      FROM enriched GROUP BY main_category) ranks
  ON e.main_category = ranks.main_category"""
)

ORACLE["label_index_topics"] = _sql(
    "articles",
    """
SELECT id, a.main_category, label
FROM (SELECT id, concat_ws(' ', category, update_date) AS main_category FROM articles) a
JOIN (SELECT main_category, CAST(row_number() OVER (ORDER BY count(*) DESC, main_category) - 1 AS DOUBLE) AS label
      FROM (SELECT concat_ws(' ', category, update_date) AS main_category FROM articles) c GROUP BY main_category) ranks
  ON a.main_category = ranks.main_category""",
)

_QUOTED = ", ".join("'" + word.replace("'", "''") + "'" for word in STOP_WORDS)
_TOKENS = f"list_filter(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]'), lambda w: w <> '')"
LABELLED = "labelled AS (SELECT id, lang, text FROM article_texts)"
WORDS = f"""tokenised AS (SELECT id, lang, {_TOKENS} AS tokens FROM labelled),
words AS (
    SELECT id, lang, tokens, list_filter(tokens, lambda w: NOT list_contains([{_QUOTED}], w)) AS words
    FROM tokenised)"""
TERMS = """terms AS (
    SELECT id, lang, term, CAST(count(*) AS INTEGER) AS tf
    FROM (SELECT id, lang, unnest(words) AS term FROM words) u GROUP BY ALL),
stats AS (
    SELECT term, CAST(sum(tf) AS BIGINT) AS "count", count(*) AS df,
           ln(((SELECT count(*) FROM labelled) + 1.0) / (count(*) + 1.0)) AS idf
    FROM terms GROUP BY term)"""



def _texts(body: str, *ctes: str) -> str:
    return _sql("article_texts", body, LABELLED, *ctes)


ORACLE["tokenise"] = _texts("SELECT id, array_to_string(tokens, ' ') AS tokens FROM words", WORDS)
ORACLE["stop_words"] = _texts("SELECT id, array_to_string(words, ' ') AS words FROM words", WORDS)
# The hash of a word (MurmurHash3, 32 bits, seed 42), written out over its ASCII codes: blocks of four, then the rest.
_TIMES = "((({0}) * {1}::UBIGINT) & 4294967295)"
_TURN = "(((({0}) << {1}) & 4294967295) | (({0}) >> (32 - {1})))"


def _mixed(block: str) -> str:
    product = _TIMES.format(block, 3432918353)
    return _TIMES.format(_TURN.format(product, 15), 461845907)


MURMUR = f"""distinct_words AS (SELECT DISTINCT unnest(words) AS word FROM words),
coded AS (SELECT word, list_transform(string_split(word, ''), lambda x: ascii(x)::UBIGINT) AS b, length(word) AS n FROM distinct_words),
blocked AS (
    SELECT word, n, list_transform(range(0, n // 4),
               lambda i: b[4 * i + 1] | (b[4 * i + 2] << 8) | (b[4 * i + 3] << 16) | (b[4 * i + 4] << 24)) AS blocks,
           CASE n % 4 WHEN 0 THEN 0::UBIGINT WHEN 1 THEN b[n] WHEN 2 THEN b[n - 1] | (b[n] << 8)
                      ELSE b[n - 2] | (b[n - 1] << 8) | (b[n] << 16) END AS rest
    FROM coded),
body AS (
    SELECT word, n, rest, list_reduce([42::UBIGINT] || blocks,
               lambda h, k: ({_TIMES.format(_TURN.format("xor(h, " + _mixed("k") + ")", 13), 5)} + 3864292196) & 4294967295) AS h
    FROM blocked),
tail AS (SELECT word, xor(CASE WHEN n % 4 = 0 THEN h ELSE xor(h, {_mixed("rest")}) END, n::UBIGINT) AS h FROM body),
first_mix AS (SELECT word, {_TIMES.format("xor(h, h >> 16)", 2246822507)} AS h FROM tail),
second_mix AS (SELECT word, {_TIMES.format("xor(h, h >> 13)", 3266489909)} AS h FROM first_mix),
hashes AS (SELECT word, xor(h, h >> 16)::BIGINT AS h FROM second_mix),
slots AS (SELECT word, CAST((((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % 20) + 20) % 20 AS INTEGER) AS slot FROM hashes)"""
ORACLE["hashed_counts"] = _texts(
    """
SELECT id, slot, count(*) AS n
FROM (SELECT id, unnest(words) AS word FROM words) w JOIN slots ON slots.word = w.word GROUP BY id, slot""",
    WORDS,
    MURMUR,
)
ORACLE["term_counts"] = _texts("SELECT id, term, tf FROM terms", WORDS, TERMS)
ORACLE["vocabulary"] = _texts('SELECT term, "count", df, round(idf, 9) AS idf FROM stats', WORDS, TERMS)
ORACLE["term_dictionary"] = _texts(
    'SELECT row_number() OVER (ORDER BY "count" DESC, term) - 1 AS term_id, term, "count", df FROM stats', WORDS, TERMS
)
ORACLE["idf_weight"] = _texts(
    "SELECT id, t.term, round(tf * idf, 9) AS weight FROM terms t JOIN stats s ON t.term = s.term", WORDS, TERMS
)
ORACLE["idf_weight_two_part"] = ORACLE["idf_weight"]

# --- learning ------------------------------------------------------------------------------

# Multinomial Naive Bayes over tf-idf, written out: priors ln(n_k + 1) - ln(N + K),
# term weights ln(s_kj + 1) - ln(s_k + V).
BAYES = """
SELECT s.id, s.lang AS main_category, own.label, best.label AS prediction
FROM (SELECT id, lang, arg_max(class, score) AS winner FROM scores GROUP BY id, lang) s
JOIN classes own ON own.class = s.lang
JOIN classes best ON best.class = s.winner"""
HELD_OUT = f"""train AS (SELECT * FROM words WHERE {BUCKET} < 80),
test AS (SELECT * FROM words WHERE {BUCKET} >= 80),
classes AS (
    SELECT lang AS class, count(*) AS n,
           CAST(row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS DOUBLE) AS label
    FROM train GROUP BY lang)"""
EVIDENCE = """train_terms AS (
    SELECT id, lang, term, count(*) AS tf
    FROM (SELECT id, lang, unnest(words) AS term FROM train) u GROUP BY ALL),
test_terms AS (
    SELECT id, lang, term, count(*) AS tf
    FROM (SELECT id, lang, unnest(words) AS term FROM test) u GROUP BY ALL),
idfs AS (
    SELECT term, ln(((SELECT count(*) FROM train) + 1.0) / (count(*) + 1.0)) AS idf
    FROM train_terms GROUP BY term),
sums AS (
    SELECT lang AS class, t.term, sum(tf * idf) AS s
    FROM train_terms t JOIN idfs i ON t.term = i.term GROUP BY ALL),
totals AS (
    SELECT c.class, c.n, ln(sum(s) + (SELECT count(*) FROM idfs)) AS den
    FROM classes c JOIN sums ON sums.class = c.class GROUP BY c.class, c.n),
priors AS (
    SELECT class, den, ln(n + 1.0) - ln((SELECT sum(n) FROM classes) + (SELECT count(*) FROM classes)) AS prior
    FROM totals),
evidence AS (
    SELECT t.id, p.class, sum(tf * idf * (ln(coalesce(s, 0) + 1.0) - den)) AS e
    FROM test_terms t JOIN idfs i ON t.term = i.term
    CROSS JOIN priors p
    LEFT JOIN sums ON sums.class = p.class AND sums.term = t.term
    GROUP BY t.id, p.class),
scores AS (
    SELECT test.id, test.lang, p.class, p.prior + coalesce(e, 0) AS score
    FROM test CROSS JOIN priors p
    LEFT JOIN evidence ev ON ev.id = test.id AND ev.class = p.class)"""
BY_CATEGORY = """labelled AS (
    SELECT id, main_category AS lang, text
    FROM article_texts JOIN taxonomy ON split_part(category, ' ', 1) = sub_category)"""

ORACLE["classify_nb"] = _texts(BAYES, WORDS, HELD_OUT, EVIDENCE)
ORACLE["classify_nb_category"] = _sql("article_texts taxonomy", BAYES, BY_CATEGORY, WORDS, HELD_OUT, EVIDENCE)
ORACLE["model_save"] = ORACLE["classify_nb"]
ORACLE["model_load"] = ORACLE["classify_nb"]
ORACLE["metric_accuracy"] = _sql(
    "scored_labels",
    "SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS accuracy FROM scored_labels",
)
ORACLE["metric_f1"] = _sql(
    "scored_labels",
    """
SELECT round(sum(n * 2.0 * tp / (n + p)) / sum(n), 9) AS f1
FROM (SELECT label, count(*) AS n, count_if(label = prediction) AS tp
      FROM scored_labels GROUP BY label) a
JOIN LATERAL (SELECT count(*) AS p FROM scored_labels q WHERE q.prediction = a.label) b ON true""",
)

# --- layout --------------------------------------------------------------------------------

ORACLE["repartition_n"] = _sql("articles", "SELECT id, category FROM articles")
ORACLE["partition_count"] = "SELECT least(12, count(*)) AS partitions FROM documents"
ORACLE["cache_materialise"] = _sql(
    "articles",
    'SELECT lang, count(*) AS "count", (SELECT count(*) FROM articles) AS total FROM articles GROUP BY lang',
)
