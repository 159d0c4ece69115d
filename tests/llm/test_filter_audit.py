"""The filter audit against playing every order document by document."""

import re
from collections import Counter
from itertools import permutations

import pytest

from folioscope.llm import filter_audit
from folioscope.llm.common import open_docs

DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"
LONG = " ".join(f"w{i}" for i in range(250))


def plain_audit(docs, labels):
    least = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    marked = Counter()
    for doc_id, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = [
            len(words) < 200,
            100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            bool(re.search("[#$%&*|]", text)),
            doc_id is not None and doc_id > least[text],
        ]
        letters = "".join(f for f, bad in zip("ABCDE", fails, strict=True) if bad)
        marked[source or "", letters, doc_id in good, doc_id in toxic] += 1
    out = {}
    for part in {m[0] for m in marked}:
        own = {m[1:]: n for m, n in marked.items() if m[0] == part}
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                row = Counter()
                for (fails, is_good, is_toxic), n in own.items():
                    gone = next((i for i, f in enumerate(order, 1) if f in fails), 9)
                    row["kept"] += n * (gone > step)
                    row["removed"] += n * (gone == step)
                    row["redundant"] += n * (letter in fails and gone < step)
                    row["unique_fails"] += n * (fails == letter)
                    row["good_lost"] += n * (gone == step and is_good)
                    row["toxic_lost"] += n * (gone == step and is_toxic)
                out[part, order, step] = dict(row)
        for letter in "ABCDE":
            rows = [r for (p, o, s), r in out.items() if p == part and o[s - 1] == letter]
            total = sum(r["removed"] for r in rows)
            for r in rows:
                r["shapley"] = total
    return out


def audited(docs, labels, tmp_path):
    path = str(tmp_path / "counts")
    filter_audit.mask_counts(docs, labels).write.parquet(path)
    rows = filter_audit.audit(docs.sparkSession.read.parquet(path)).collect()
    out = {(r["part"], r["filter_order"], r["step"]): r.asDict() for r in rows}
    assert len(out) == len(rows)
    for row in out.values():
        for name in ("part", "filter_order", "step"):
            row.pop(name)
    return out


def test_ranks_and_intervals():
    assert [filter_audit.lehmer_rank(o, 5) for o in permutations(range(5))] == list(range(120))
    for mask in range(1, 32):
        for rank, order in enumerate(permutations(range(5))):
            step = next(i for i, f in enumerate(order, 1) if mask >> f & 1)
            hits = [s for m, s, b, e in filter_audit.intervals() if m == mask and b <= rank < e]
            assert hits == [step]


def test_small_cases(frame, tmp_path):
    rows = [
        (1, "Same text", "a"), (2, "Same text", "a"), (2, "Same text", "b"), (3, "Same text", None), (None, "Same text", "a"),
        (4, None, ""), (5, "", "b"), (None, None, "b"), (6, "  \t\n ", "b"), (7, LONG, "a"), (7, LONG, "a"), (8, LONG, "b"),
        (9, LONG + " #", "b"), (10, "AB " + LONG, "b"), (11, "w " * 300, "a"), (12, "w " * 150 + LONG, None), (13, "é\x0bÀ\x1c Z" * 90, "a"),
        (None, LONG, "c"), (14, LONG.upper(), "c"), (15, "x " * 100_000 + "|", "c"),
    ]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (7, 1, 1), (8, None, 1), (9, 1, None), (None, 1, 1), (99, 1, 1), (15, 0, 0)]
    docs = frame([(*r, "clash", 5) for r in rows], DOCS + ", mask string, n int")
    marks = frame([(*r, "clash") for r in labels], LABELS + ", source string")
    assert audited(docs, marks, tmp_path) == plain_audit(rows, labels)


def test_empty_tables(frame, tmp_path):
    assert audited(frame([], DOCS), frame([(1, 1, 1)], LABELS), tmp_path) == {}
    assert len(audited(frame([(1, "a", "s")], DOCS), frame([], LABELS), tmp_path / "b")) == 600


@pytest.mark.parametrize("parts", [1, 7])
def test_whole_table(spark, data, tmp_path, parts):
    docs, labels = open_docs(spark, data).repartition(parts), open_docs(spark, data, "labels")
    expected = plain_audit(
        [tuple(r) for r in docs.select("doc_id", "text", "source").collect()],
        [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()],
    )
    assert audited(docs, labels, tmp_path) == expected


def test_texts_are_not_shuffled(spark, data, plan_of):
    plan = plan_of(filter_audit.mask_counts(open_docs(spark, data), open_docs(spark, data, "labels")))
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    exchanges = [line for block in plan.split("\n\n") if ") Exchange" in block for line in block.splitlines() if "Input" in line]
    assert exchanges and not any("text#" in line for line in exchanges)
