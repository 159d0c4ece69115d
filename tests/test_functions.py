import datetime
import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioscope import functions as fn
from folioscope.functions.jsonscan import line_body
from folioscope.plans.oracle import STOP_WORDS

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def column(spark, values, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "n int, v string").select("n", expression.alias("out"))
    return [row["out"] for row in sorted(df.collect(), key=lambda row: row["n"])]


def test_article_date(spark):
    cases = {
        "math/0309136": datetime.date(2003, 9, 1),
        "hep-th/9901001": datetime.date(1999, 1, 1),
        "math/9001001": datetime.date(1990, 1, 1),
        "math/8912001": datetime.date(2089, 12, 1),
        "0704.0001": datetime.date(2007, 4, 1),
        "9912.0001": datetime.date(2099, 12, 1),
        "cond-mat/9013001": None,
        "2513.00001": None,
        "abcd": None,
        "math/": None,
        "": None,
        None: None,
    }
    assert column(spark, cases, fn.article_date("v")) == list(cases.values())


def expected_date(identifier):
    old = "/" in identifier
    digits = identifier.split("/")[1] if old else identifier
    century = "19" if old and digits[:2] >= "90" else "20"
    found = re.fullmatch(r"([0-9]{4})([0-9]{2})", century + digits[:4])
    if not found or not 1 <= int(found[2]) <= 12 or len(digits) < 4:
        return None
    return datetime.date(int(found[1]), int(found[2]), 1)


@few
@given(st.lists(st.from_regex(r"([a-z]{1,3}/)?[0-9./]{0,8}", fullmatch=True), min_size=50, max_size=100))
def test_article_date_on_any_identifier(spark, identifiers):
    assert column(spark, identifiers, fn.article_date("v")) == [expected_date(i) for i in identifiers]


def test_author_count(spark):
    lists = ["A", "A and B", "A, B and C", "A, B, and C", "X. Anderson, Y. Brand", "", None]
    assert column(spark, lists, fn.author_count("v")) == [1, 2, 3, 4, 2, 1, None]
    assert column(spark, lists, fn.author_count("v", missing=-1))[-1] == -1
    assert column(spark, lists, fn.author_count("v", clean=True)) == [1, 2, 3, 3, 2, 0, None]


def test_text_concat(spark):
    df = spark.createDataFrame([("t", None), (None, None), ("a", "b")], "title string, abstract string")
    assert [r[0] for r in df.select(fn.text_concat()).collect()] == ["t", "", "a b"]


def test_categories(spark):
    codes = ["hep-ph cs.AI", "", None, "cs.AI math.CO", "math-ph", "eess.SP", "q-bio.GN", "stat"]
    assert column(spark, codes, fn.primary_category("v")) == [
        "hep-ph", "", None, "cs.AI", "math-ph", "eess.SP", "q-bio.GN", "stat",
    ]
    assert column(spark, codes, fn.category_case("v")) == [
        "physics", "physics", "physics", "computer science", "physics",
        "electrical engineering", "quantitative biology", "statistics",
    ]
    assert column(spark, ["eess.SP"], fn.category_case("v", short=False)) == [
        "electrical engineering and systems science"
    ]
    names = ["Electrical Engineering and Systems Science", "Physics", None]
    assert column(spark, names, fn.category_shorten("v")) == ["Electrical Engineering", "Physics", None]


def test_update_date_and_parens(spark):
    assert column(spark, ["2008-11-26\t", "\t", None], fn.clean_update_date("v")) == ["2008-11-26", "", None]
    wrapped = ["(Artificial Intelligence)", "((a) b)", "()", None]
    assert column(spark, wrapped, fn.strip_parens("v")) == ["Artificial Intelligence", "a) b", "", None]


def test_tokens(spark):
    text = "We \\n study\\nfoo-bar É été naïve x_1 don't"
    assert column(spark, [text], fn.tokens("v")) == [
        ["we", "n", "study", "nfoo", "bar", "t", "na", "ve", "x_1", "don", "t"]
    ]


def test_stop_words_are_sparks_own(spark):
    assert fn.english_stop_words() and sorted(STOP_WORDS) == sorted(fn.english_stop_words())
    assert column(spark, ["The cat and THE dog"], fn.stop_words_removed(fn.tokens("v"))) == [["cat", "dog"]]


@few
@given(st.lists(st.lists(st.sampled_from("ab abc b é zz".split()), max_size=30), min_size=10, max_size=40))
def test_term_frequencies_count_every_word(spark, documents):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(documents)], "n int, words array<string>")
    got = {r["n"]: r["t"] for r in df.select("n", fn.term_frequencies("words").alias("t")).collect()}
    for n, words in enumerate(documents):
        pairs = [(entry["term"], entry["tf"]) for entry in got[n] or []]
        assert len(pairs) == len(set(pairs)) and dict(pairs) == Counter(words)


def scanned(line, key, skip):
    line = line.strip()[1:-1]
    at = line.find(f'"{key}"')
    if at < 0:
        return "None"
    rest = line[at + len(key) + 2 + skip :]
    end = rest.find('"')
    return rest[:end] if end >= 0 else rest[: max(len(rest) - 1, 0)]


def test_scan_field_keeps_its_quirks(spark):
    line = r' {"id":"x1","title":"T \"q\" x","journal_ref":null,"abstract":"  two","end":"z} '
    for key, skip, value in [
        ("id", 2, "x1"),
        ("title", 2, "T \\"),
        ("journal_ref", 3, "ll,"),
        ("abstract", 3, " two"),
        ("absent", 2, "None"),
        ("end", 2, ""),
    ]:
        body = line_body("v")
        assert column(spark, [line], fn.scan_field(body, key, skip)) == [value]
        assert scanned(line, key, skip) == value


@few
@given(st.lists(st.text(alphabet='{}":, abid\\', max_size=30), min_size=40, max_size=80))
def test_scan_field_on_any_line(spark, lines):
    got = column(spark, lines, fn.scan_field(line_body("v"), "id", 2))
    assert got == [scanned(line, "id", 2) for line in lines]


def test_expressions_take_columns_and_names(spark):
    df = spark.createDataFrame([("0704.0001",)], "id string")
    by_column = df.select(fn.article_year(fn.article_date(F.col("id")))).first()[0]
    assert by_column == 2007
