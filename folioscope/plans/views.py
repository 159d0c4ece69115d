"""Article-shaped views over the given tables.

Each view is one SQL text that Spark and DuckDB both run, so a query and its
check start from the same rows. Views cover what real metadata holds: both
identifier styles, an impossible month, absent authors, an Oxford comma, NULL
titles and abstracts, several categories, unknown categories, stray tabs.
"""

from pyspark.sql import DataFrame, SparkSession

TABLES = ("nation", "region", "documents", "labels", "pages", "events")

VIEWS: dict[str, str] = {}

# An article's identifier and category, from documents numbered as in NUMBERED.
ID = """CASE WHEN (doc_id % 11) % 4 = 0 THEN 'math/' || yy_old || mm || lpad(CAST(doc_id AS VARCHAR(20)), 6, '0')
            ELSE yy_new || mm || '.' || lpad(CAST(doc_id AS VARCHAR(20)), 6, '0') END AS id"""
CATEGORY = """CASE WHEN doc_id % 31 = 30 THEN 'retired.XX'
            WHEN doc_id % 3 = 0 THEN source || ' ' || lang
            ELSE source END AS category"""
NUMBERED = """(SELECT *, lpad(CAST((91 + doc_id % 17) % 100 AS VARCHAR(20)), 2, '0') AS yy_old,
             lpad(CAST(7 + doc_id % 17 AS VARCHAR(20)), 2, '0') AS yy_new,
             CASE WHEN doc_id % 97 = 96 THEN '13'
                  ELSE lpad(CAST(1 + doc_id % 12 AS VARCHAR(20)), 2, '0') END AS mm
      FROM documents) d"""

# Flat article records, one per document.
VIEWS["articles"] = f"""
SELECT {ID},
       CASE WHEN doc_id % 101 = 100 THEN NULL
            WHEN (doc_id % 13) % 5 = 0 THEN 'A. Author'
            WHEN (doc_id % 13) % 5 = 1 THEN 'A. Author and B. Writer'
            WHEN (doc_id % 13) % 5 = 2 THEN 'A. Author, B. Writer and C. Scribe'
            WHEN (doc_id % 13) % 5 = 3 THEN 'A. Author, B. Writer, and C. Scribe'
            ELSE 'X. Anderson, Y. Brand' END AS authors,
       CASE WHEN doc_id % 59 = 58 THEN NULL ELSE substring(text, 1, 40) END AS title,
       CASE WHEN doc_id % 53 = 52 THEN NULL ELSE text END AS abstract,
       'None' AS journal_ref,
       {CATEGORY},
       '20' || yy_new || '-' || mm || '-01' || chr(9) AS update_date,
       doc_id, lang
FROM {NUMBERED}
"""

# The same articles with their whole texts, for words and learning.
VIEWS["article_texts"] = f"""
SELECT {ID}, {CATEGORY}, lang, text
FROM {NUMBERED}
"""

# Articles whose titles hold line breaks and the record delimiter.
VIEWS["broken_titles"] = """
SELECT id, authors, title || ' :: part' || chr(13) || chr(10) || 'two' AS title, abstract, journal_ref, category, update_date
FROM articles
"""

# The category taxonomy of those articles.
VIEWS["taxonomy"] = """
SELECT r_name AS main_category,
       'src' || CAST(n_nationkey AS VARCHAR(20)) AS sub_category,
       n_name AS description
FROM nation JOIN region ON n_regionkey = r_regionkey
"""

# Articles under archive-style category codes, some of them missing.
VIEWS["coded_articles"] = """
SELECT id, title, abstract, doc_id,
       CASE doc_id % 12
            WHEN 0 THEN 'cs.AI' WHEN 1 THEN 'cs.LG math.CO' WHEN 2 THEN 'math.AG'
            WHEN 3 THEN 'econ.EM' WHEN 4 THEN 'eess.SP' WHEN 5 THEN 'q-bio.GN'
            WHEN 6 THEN 'q-fin.PR' WHEN 7 THEN 'stat.ML' WHEN 8 THEN 'hep-ph'
            WHEN 9 THEN 'math-ph cs.AI' WHEN 10 THEN '' END AS category
FROM articles
"""

# The same articles as one JSON object per line, with escapes, null and absent keys.
VIEWS["raw_lines"] = """
SELECT doc_id,
       '  {"id":"' || id || '","submitter":"S. Ender",' ||
       CASE WHEN authors IS NULL THEN '' ELSE '"authors":"' || authors || '",' END ||
       '"title":' || coalesce('"' || title_text || '"', 'null') || ',"comments":null,' ||
       CASE doc_id % 4 WHEN 0 THEN '"journal-ref":null,' WHEN 1 THEN '"journal-ref":"J. Test 1 (2001) 5",'
                       WHEN 2 THEN '"journal_ref":" Old J. 7",' ELSE '' END ||
       '"categories":"' || category || '","license":null,"abstract":' ||
       coalesce('"  ' || abstract_text || '"', 'null') ||
       ',"versions":[],"update_date":"' || substring(update_date, 1, 10) || '"} ' AS value
FROM (SELECT *,
             replace(replace(replace(title, chr(92), chr(92) || chr(92)), '"', chr(92) || '"'),
                     chr(10), chr(92) || 'n') AS title_text,
             replace(replace(replace(abstract, chr(92), chr(92) || chr(92)), '"', chr(92) || '"'),
                     chr(10), chr(92) || 'n') AS abstract_text
      FROM articles) a
"""

# Web pages that carry a taxonomy section: two entries and the heading entry each.
VIEWS["taxonomy_parts"] = """
SELECT page_id, url, html,
       CASE page_id % 8 WHEN 0 THEN 'cs' WHEN 1 THEN 'econ' WHEN 2 THEN 'eess' WHEN 3 THEN 'math'
            WHEN 4 THEN 'q-bio' WHEN 5 THEN 'q-fin' WHEN 6 THEN 'stat' ELSE 'hep-th' END
       || '.' || CAST(page_id AS VARCHAR(20)) AS code,
       CASE page_id % 8 WHEN 0 THEN 'Computer Science' WHEN 1 THEN 'Economics'
            WHEN 2 THEN 'Electrical Engineering and Systems Science' WHEN 3 THEN 'Mathematics'
            WHEN 4 THEN 'Quantitative Biology' WHEN 5 THEN 'Quantitative Finance'
            WHEN 6 THEN 'Statistics' ELSE 'Physics' END AS main_name
FROM pages
"""

VIEWS["taxonomy_pages"] = """
SELECT page_id,
       html || '<h2 class="accordion-head"> ' || main_name || chr(10) || '</h2>' ||
       '<div class="columns divided"><div class="column"><h4>Category Name <span>(Full Name)</span></h4></div></div>' ||
       '<div class="columns divided"><div class="column is-one-fifth"><h4> ' || code ||
       ' <span>(Topics &amp; Methods (' || CAST(page_id AS VARCHAR(20)) || '))</span></h4></div><p>' || url ||
       '</p></div><DIV class="columns divided"><h4>' || code || 'x' || chr(10) || 'bare</h4></DIV>' ||
       '<div class="columns divided"><div><div>' || url || '</div></div><div><h4>' || code ||
       '&#46;y <span>(Caf&eacute; &#x26; &#8211; ' || url || ' &amp;lt;)</span></h4></div></div><h4>footer' || code || ' <span>(none)</span></h4>' ||
       '<div class="columns divided"><div>no head</div></div><div><h4>after <span>(none)</span></h4></div>' AS html
FROM taxonomy_parts
"""

# Articles several times over: later revisions, and one identifier that a third of all rows share.
VIEWS["revisions"] = """
SELECT CASE WHEN doc_id % 3 = 0 THEN 'hep-th/9901001' ELSE id END AS id, title, category, update_date, doc_id
FROM articles
UNION ALL
SELECT CASE WHEN doc_id % 3 = 0 THEN 'hep-th/9901001' ELSE id END AS id, title, category, '2030-01-01' AS update_date, doc_id
FROM articles
WHERE doc_id % 2 = 0
"""

# A stored prediction table and updates to it, which together cover all articles and overlap; some rows lack an identifier.
VIEWS["stored_predictions"] = """
SELECT CASE WHEN doc_id % 41 = 40 THEN NULL ELSE id END AS id, title, lang AS main_category,
       CAST(doc_id % 4 AS DOUBLE) AS label, CAST(doc_id % 5 AS DOUBLE) AS prediction
FROM articles
WHERE doc_id % 10 < 7
"""

VIEWS["new_predictions"] = """
SELECT CASE WHEN doc_id % 43 = 42 THEN NULL ELSE id END AS id, title, 'renamed' AS main_category,
       CAST(doc_id % 7 AS DOUBLE) AS label, CAST(doc_id % 3 AS DOUBLE) AS prediction
FROM articles
WHERE doc_id % 10 >= 4
"""

# A labelled set with a deterministic prediction for every row.
VIEWS["scored_labels"] = """
SELECT doc_id, CAST(quality AS DOUBLE) AS label, CAST(1 - toxic AS DOUBLE) AS prediction
FROM labels
"""

# What each view reads besides the given tables.
PARENTS = {
    "coded_articles": ("articles",),
    "raw_lines": ("articles",),
    "broken_titles": ("articles",),
    "taxonomy_pages": ("taxonomy_parts",),
    "revisions": ("articles",),
    "stored_predictions": ("articles",),
    "new_predictions": ("articles",),
}


def view_ctes(*names: str) -> list[str]:
    """Common table expressions for the named views, parents first."""
    needed: list[str] = []
    for name in names:
        for view in (*PARENTS.get(name, ()), name):
            if view not in needed:
                needed.append(view)
    return [f"{view} AS ({VIEWS[view].strip()})" for view in needed]


def open_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame over the Parquet tables in ``sf_dir``."""
    tables = [f"{t} AS (SELECT * FROM parquet.`{sf_dir}/{t}.parquet`)" for t in TABLES]
    ctes = ",\n".join([*tables, *view_ctes(name)])
    return spark.sql(f"WITH {ctes}\nSELECT * FROM {name}")


def open_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
