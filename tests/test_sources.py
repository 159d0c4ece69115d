import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from folioscope.plans.preprocess import convert
from folioscope.sources import delimited, raw_json, tables, taxonomy_pages

PAGE = """<html><h2 class="accordion-head">Computer Science</h2>
<div class="columns divided"><div class="column is-one-fifth"><h4>Category Name <span>(Name)</span></h4></div></div>
<div class="columns divided"><div><h4>cs.AI <span>(Artificial Intelligence)</span></h4></div><p>(not this)</p></div>
<div class="columns divided"><h4>  eess.SP
  <span>(Signals &amp; Systems (all))</span></h4></div>
<div class="columns divided"><h4>hep-th</h4></div>
<div class="columns">other</div><h2 class="accordion-head"> Physics </h2></html>"""


def test_taxonomy_page(spark, frame):
    pages = frame([(PAGE,), ("<p>no taxonomy</p>",), (None,)], "html string")
    rows = {tuple(r) for r in taxonomy_pages.taxonomy_table(pages).collect()}
    assert rows == {
        ("Computer Science", "cs.AI", "Artificial Intelligence"),
        ("Electrical Engineering and Systems Science", "eess.SP", "Signals & Systems (all"),
        ("Physics", "hep-th", None),
    }
    heads = {tuple(r) for r in taxonomy_pages.main_category_rows(pages).collect()}
    assert heads == {("Computer Science", "ArXiv", ""), ("Physics", "ArXiv", "")}


def test_parsed_lines(frame):
    lines = frame(
        [
            ('{"id":"1","title":"a \\"b\\"\\nc","journal-ref":"J","journal_ref":"K","categories":"cs.AI x"}',),
            ('{"id":"2","title":null,"journal_ref":"K"}',),
            ("not json",),
        ],
        "value string",
    )
    rows = raw_json.parse_lines(lines).select("id", "title", "journal_ref", "category").collect()
    assert [tuple(r) for r in rows] == [
        ("1", 'a "b"\nc', "J", "cs.AI x"),
        ("2", None, "K", None),
        (None, None, None, None),
    ]


def test_records_survive_a_round_trip(spark, frame, tmp_path):
    rows = [
        ("1", 'A "x"', '"Quoted" start', "abs", "None", "cs.AI", "2007-01-01\t"),
        ("2", None, "t, with comma", None, None, "math.CO cs.AI", "2008-01-01"),
    ]
    names = "id authors title abstract journal_ref category update_date".split()
    articles = frame(rows, ", ".join(f"{n} string" for n in names)).repartition(2)
    path = str(tmp_path / "records")
    raw_json.write_lines(raw_json.flatten_records(articles), path)
    read = delimited.read_records(spark, path + "/part*")
    assert read.columns == names
    assert sorted(tuple(r) for r in read.collect()) == rows


def test_delimiter_inside_a_field_shifts_columns(spark, tmp_path):
    path = tmp_path / "r.txt"
    path.write_text("0704.0002::D::T :: two::abs::None::cs.AI::2007-01-01\n")
    row = delimited.read_records(spark, str(path)).first()
    assert (row["title"], row["abstract"], row["update_date"]) == ("T ", " two", "cs.AI")


def test_header_csv_with_long_text(spark, tmp_path):
    rows = [(1, 'a "quoted" word, and\na line break\n\n"end"'), (2, "plain"), (3, None), (4, "long " * 20_000 + "\nend")]
    path = str(tmp_path / "long")
    spark.createDataFrame(rows, "n int, text string").write.option("header", True).option("escape", '"').csv(path)
    got = delimited.read_header_csv(spark, path, "n int, text string", multi_line=True).collect()
    assert sorted((r.n, r.text) for r in got) == rows


def test_header_csv(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text('main,n\n"a, ""b""",1\nc,2\n')
    df = delimited.read_header_csv(spark, str(path))
    assert dict(df.dtypes) == {"main": "string", "n": "int"}
    assert [tuple(r) for r in df.collect()] == [('a, "b"', 1), ("c", 2)]
    assert delimited.read_header_csv(spark, str(path), schema="main string, n string").first()["n"] == "1"


def test_write_modes(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(frame([(1,)], "n int"), path, max_records_per_file=1)
    with pytest.raises(AnalysisException):
        tables.write_table(frame([(2,)], "n int"), path)
    tables.write_if_absent(frame([(2,)], "n int"), path)
    assert [r["n"] for r in tables.read_table(spark, path).collect()] == [1]
    tables.write_table(frame([(3,)], "n int"), path, mode="overwrite")
    assert [r["n"] for r in tables.read_table(spark, path).collect()] == [3]


def test_unfinished_folder_is_written_again(spark, frame, tmp_path):
    """What a killed job leaves: a folder with temporary files and no mark of success."""
    path = tmp_path / "t"
    (path / "_temporary" / "0").mkdir(parents=True)
    tables.write_if_absent(frame([(2,)], "n int"), str(path))
    assert [r["n"] for r in tables.read_table(spark, str(path)).collect()] == [2]
    tables.write_if_absent(frame([(3,)], "n int"), str(path))
    assert [r["n"] for r in tables.read_table(spark, str(path)).collect()] == [2]


def test_parsed_records_stay_on_one_line(spark, frame, tmp_path):
    line = '{"id":"1","title":"a\\nb","abstract":"c :: d\\r\\n\\ne","authors":"A::B"}'
    (tmp_path / "raw.json").write_text(line + "\n")
    convert(spark, f"{tmp_path}/raw.json", f"{tmp_path}/records", exact=False)
    got = delimited.read_records(spark, f"{tmp_path}/records").collect()
    assert [(r["id"], r["title"], r["abstract"], r["authors"]) for r in got] == [("1", "a b", "c : : d e", "A: :B")]


def test_partitioned_write_prunes(spark, frame, tmp_path, plan_of):
    path = str(tmp_path / "p")
    df = spark.range(90).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("main_category"))
    tables.write_partitioned(df, path)
    read = tables.read_table(spark, path)
    assert read.count() == 90
    only = read.where(F.col("main_category") == "a")
    assert only.count() == 30
    assert "PartitionFilters: [isnotnull(main_category" in plan_of(only)


def test_whole_pages(spark, tmp_path):
    from folioscope.plans.preprocess import build_taxonomy, read_pages

    (tmp_path / "page.html").write_text(PAGE)
    out = str(tmp_path / "tax")
    build_taxonomy(read_pages(spark, str(tmp_path / "page.html")), out)
    mains = {r["sub_category"]: r["main_category"] for r in tables.read_table(spark, out).collect()}
    assert mains == {"cs.AI": "Computer Science", "eess.SP": "Electrical Engineering", "hep-th": "Physics"}
