"""Records broken over several lines, character references, nested blocks."""

import html

import pytest
from pyspark.sql import functions as F

from folioscope.schema import ARTICLE_SCHEMA
from folioscope.sources import delimited, taxonomy_pages

FIELDS = len(ARTICLE_SCHEMA)


def read(spark, path):
    return sorted(map(tuple, delimited.read_broken_records(spark, path).collect()), key=str)


@pytest.mark.parametrize("split", ["128m", "64b"])
def test_broken_records_come_back_whole(spark, tmp_path, split):
    """Also where a record spans the splits of a file."""
    records = []
    for i in range(60):
        fields = [f"{name} {i}" for name in ARTICLE_SCHEMA.fieldNames()]
        if i % 3 == 0:
            fields[2] = f"title\n\nof {i}"
        if i % 4 == 0:
            fields[3] = "line\n" * 5 + "\rend"
        if i % 5 == 0:
            fields[1] = ""
        if i % 15 == 0:
            fields[6] = "2020\nlate"
        records.append(fields)
    for part, lines in enumerate((records[:25], records[25:])):
        (tmp_path / f"part-{part}").write_bytes("".join("::".join(r) + "\n" for r in lines).encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = read(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found == sorted((tuple(f or None for f in r) for r in records), key=str)


def test_stray_lines_do_not_shift_later_records(spark, tmp_path):
    whole = "::".join(f"f{i}" for i in range(FIELDS))
    (tmp_path / "a").write_text(f"{whole}\nstray\n{whole}\na::b\n{whole}\n")
    found = read(spark, str(tmp_path))
    assert found.count(tuple(f"f{i}" for i in range(FIELDS))) == 3
    assert ("stray", *[None] * 6) in found and ("a", "b", *[None] * 5) in found and len(found) == 5


def test_no_lines(spark, tmp_path):
    (tmp_path / "a").write_text("")
    assert read(spark, str(tmp_path)) == []


def test_whole_lines_are_not_shuffled_as_text(spark, tmp_path, plan_of):
    (tmp_path / "a").write_text("x")
    plan = plan_of(delimited.read_broken_records(spark, str(tmp_path)))
    exchanges = [line for block in plan.split("\n\n") if ") Exchange" in block for line in block.splitlines() if "Input" in line]
    assert exchanges and not any("value#" in line for line in exchanges)


def test_references(frame):
    texts = ["a &amp; b", "&lt;i&gt;", "&#65;&#x42;&#X43;", "&eacute;&Eacute;&mdash;", "&amp;lt;", "&unknown; &", "none", "", "&#128512;&copy", "x&quot;&#39;&apos;y", "&"]
    df = frame([(t,) for t in [*texts, None]], "t string")
    found = [r[0] for r in df.select(taxonomy_pages.decoded("t")).collect()]
    assert found == [*[html.unescape(t.replace("&copy", "&amp;copy")) for t in texts], None]
    odd = frame([("&#0;&#xD800;&#1114112;&#9999999;&nbsp;",)], "t string").select(taxonomy_pages.decoded("t")).first()[0]
    assert odd == "�" * 4 + " "


@pytest.mark.parametrize(
    "rest,inside",
    [
        ("a</div>b", "a"),
        ("a<div>b</div>c</div>d<h4>", "abc"),
        ("a<DIV class='x'><div>b</DIV></div >c</div></div>d", "abc"),
        ("never closed <div>x", "never closed x"),
        ("", ""),
        ("</div>", ""),
        ("a<divide>b</div>c", "a<divide>b"),
    ],
)
def test_blocks_end_at_their_own_depth(frame, rest, inside):
    assert frame([(rest,)], "t string").select(taxonomy_pages.own_block(F.col("t"))).first()[0] == inside
