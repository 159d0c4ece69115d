import json

import pytest

from folioscope.__main__ import main
from folioscope.operators.dedupe import dedupe_by_id
from folioscope.operators import trends

PREFIXES = [("cs.AI", "cat kitten purr"), ("math.CO", "graph vertex edge"), ("hep-th", "brane string dual")]
PAGE = "".join(
    f'<div class="columns divided"><h4>{code} <span>(Topic of {code})</span></h4></div>' for code, _ in PREFIXES
)


@pytest.fixture
def folder(spark, tmp_path):
    """Raw inputs: JSON lines, a taxonomy page."""
    lines = []
    for n in range(240):
        code, words = PREFIXES[n % 3]
        record = {
            "id": f"{7 + n % 5:02d}{1 + n % 12:02d}.{n:05d}",
            "submitter": "S",
            "authors": "A. One and B. Two" if n % 2 else "A. One, B. Two, C. Three",
            "title": f"On {words.split()[n % 3]}",
            "journal-ref": None,
            "categories": f"{code} cs.LG",
            "abstract": f"  We study {words} number{n}",
            "update_date": "2010-01-01",
        }
        lines.append(json.dumps(record, separators=(",", ":")))
    (tmp_path / "raw.json").write_text("\n".join(lines) + "\n")
    (tmp_path / "page.html").write_text(PAGE)
    return tmp_path


def test_every_job_end_to_end(spark, folder, capsys):
    at = str(folder)
    main(["convert", f"{at}/raw.json", f"{at}/records"])
    main(["taxonomy", f"{at}/page.html", f"{at}/taxonomy"])
    main(["preprocess", f"{at}/records/part*", f"{at}/taxonomy", f"{at}/tables"])

    enriched = spark.read.parquet(f"{at}/tables/preprocessing")
    assert enriched.columns == "id text title abstract authers_num article_date main_category main_topic".split()
    assert enriched.count() == 240
    row = enriched.where("id = '0701.00000'").first()
    assert (row["authers_num"], str(row["article_date"]), row["main_category"], row["main_topic"]) == (
        3, "2007-01-01", "Computer Science", "Topic of cs.AI",
    )
    assert row["text"] == "On cat  We study cat kitten purr number0"
    sizes = {p: spark.read.parquet(f"{at}/tables/testing/{p}").count() for p in ("test1", "test2", "test3")}
    assert 0 < sizes["test1"] < sizes["test2"] < sizes["test3"] < 240

    main(["analyse", f"{at}/tables/preprocessing", f"{at}/reports"])
    narrow = dedupe_by_id(enriched.drop("text", "title", "abstract"))
    for name, direct in {
        "categories": trends.count_by_category(narrow),
        "years": trends.count_by_year_category(narrow),
        "authors_by_year": trends.author_stats_by_year(narrow, with_min=True),
        "authors_by_category": trends.author_stats(narrow, "main_category", with_min=True),
        "topics": trends.topic_counts(narrow),
    }.items():
        report = spark.read.parquet(f"{at}/reports/{name}")
        assert sorted(report.select(*direct.columns).collect()) == sorted(direct.collect()), name

    main(["classify", f"{at}/tables", "test1", f"{at}/scores/1", "--model", f"{at}/model"])
    main(["classify", f"{at}/tables", "test3", f"{at}/scores/2", "--current", f"{at}/scores/1"])
    assert capsys.readouterr().out.count("accuracy = 1") == 2
    merged = spark.read.parquet(f"{at}/scores/2")
    assert merged.columns == ["id", "main_category", "label", "prediction"]
    assert merged.count() == merged.select("id").distinct().count() == sizes["test3"]

    assert spark.read.parquet(f"{at}/tables/unmatched").count() == 0
    settings = ["--set", "maxIter=20", "--set", "regParam=0.01", "--max-classes", "5"]
    main(["classify-records", f"{at}/records/part*", "3", "0.2", f"{at}/scores/3", *settings])
    scored = spark.read.parquet(f"{at}/scores/3")
    assert scored.columns == ["id", "title", "main_category", "label", "prediction"]
    assert {r[0] for r in scored.select("main_category").distinct().collect()} == {
        "computer science", "mathematics", "physics",
    }


def test_second_preprocessing_keeps_old_tables_unless_told(spark, folder):
    at = str(folder)
    main(["taxonomy", f"{at}/page.html", f"{at}/taxonomy"])
    job = ["preprocess", f"{at}/raw.json", f"{at}/taxonomy", f"{at}/tables", "--json", "--disjoint"]
    main(job)
    train = {r["id"] for r in spark.read.parquet(f"{at}/tables/training").collect()}
    test = {r["id"] for r in spark.read.parquet(f"{at}/tables/testing/test3").collect()}
    assert train and test and not train & test
    raw = folder / "raw.json"
    raw.write_text("\n".join(raw.read_text().splitlines()[:30]) + "\n")
    main(job)
    assert spark.read.parquet(f"{at}/tables/preprocessing").count() == 240
    main([*job, "--overwrite"])
    spark.catalog.clearCache()
    assert spark.read.parquet(f"{at}/tables/preprocessing").count() == 30


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    from folioscope import session

    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster)
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
