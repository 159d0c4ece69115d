"""Language identification: held-out accuracy, rejection, edge rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.llm import langid
from folioscope.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_contract(spark):
    rows = QUERIES["op1_language_id"](spark, DATA).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    right = total = rejected = 0
    for row in rows:
        doc = docs[row.doc_id]
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.lang_pred in {"en", "fr", "de", "es", "und"}
        assert (row.lang_pred == "und") == (not any(c.isalpha() for c in doc.text or ""))
        if row.held_out and doc.lang:
            total += 1
            right += row.lang_pred == doc.lang
        rejected += row.rejected
    assert right / total > 0.97, (right, total)
    assert rejected <= 0.01 * len(rows)


def test_counts_agree_with_a_plain_count(monkeypatch):
    text = "Ábc abc, the end of théma 12".lower().encode()
    clean = langid._normal(text)
    plain = np.zeros(langid.FEATURES)
    for n in (1, 2, 3):
        for i in range(len(clean) - n + 1):
            code = int.from_bytes(clean[i : i + n], "big")
            plain[((code + n) * langid._SALT[n - 1] % 2**32) >> int(langid._SHIFT)] += 1
    assert (langid.counts([text])[0] == plain).all()
    monkeypatch.setattr(langid, "STEP_BYTES", 7)  # slices of a long text change nothing
    assert (langid.counts([b"", text, text])[1:] == plain).all()


def test_edge_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !!", "fr"), (4, "the cat and the dog", "en"), (4, "the cat and the dog", "en")]
    rows += [(9, "le chat et le chien", "fr"), (5, "le chat", None), (6, "x" * 3000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumnRenamed("doc_id", "key")
    model = langid.fit(docs)
    assert sorted(set(model.languages)) == ["en", "fr"]
    again = docs.withColumnRenamed("lang", "score")  # an extra column with the name of an output
    found = langid.predict(again, model)
    assert found.columns == ["key", "text", "lang_pred", "score", "rejected"]
    got = sorted((r.key, r.lang_pred, r.rejected) for r in found.collect())
    assert got[:3] == [(1, "und", True), (2, "und", True), (3, "und", True)]
    assert got[3:5] == [(4, "en", False)] * 2 and got[5][:2] == (5, "fr") and got[7][:2] == (9, "fr")


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "key long, text string, lang string")
    row = langid.predict(docs, langid.fit(docs)).first()
    assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
    assert langid.predict(docs.limit(0), langid.fit(docs.limit(0))).collect() == []


LATIN = {
    "it": "tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. essi sono dotati di ragione e di coscienza e devono agire "
    "gli uni verso gli altri in spirito di fratellanza. ogni individuo ha diritto alla vita, alla libertà ed alla sicurezza.",
    "fi": "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. heille on annettu järki ja omatunto, ja heidän on "
    "toimittava toisiaan kohtaan veljeyden hengessä.",
    "pl": "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. są oni obdarzeni rozumem i sumieniem i powinni "
    "postępować wobec innych w duchu braterstwa.",
}


def test_junk_and_unlearned_languages_in_latin_letters_are_rejected(spark):
    import base64
    import random

    rng = random.Random(1)
    junk = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(n)) for n in (200, 400, 3000)]
    junk += [base64.b64encode(rng.randbytes(n)).decode() for n in (200, 2000)]
    junk += list(LATIN.values()) + [" ".join([t] * 10) for t in LATIN.values()]
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select(F.col("doc_id").alias("key"), "text", "lang")
    held = F.crc32(F.col("key").cast("string")) % 5 == 0
    model = langid.fit(docs.where(~held))
    found = langid.predict(spark.createDataFrame([(t,) for t in junk], "text string"), model).collect()
    assert [r.text[:40] for r in found if not r.rejected] == []
    clean = langid.predict(docs.where(held & langid.has_letter(F.col("text"))).drop("lang"), model)
    share = clean.agg(F.avg(F.col("rejected").cast("int"))).first()[0]
    assert share < 0.01


def plain_nearest(model, text):
    """The definition, one n-gram at a time."""
    clean = langid._normal(text.lower().encode())
    x = np.zeros(langid.FEATURES)
    for n in (1, 2, 3):
        for i in range(len(clean) - n + 1):
            code = int.from_bytes(clean[i : i + n], "big")
            x[((code + n) * langid._SALT[n - 1] % 2**32) >> int(langid._SHIFT)] += 1
    x = x * model.idf
    x /= np.linalg.norm(x)
    cosine = [float(sum(x * c)) for c in model.centroids]
    return int(np.argmax(cosine)), max(cosine)


def test_predictions_against_a_plain_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("doc_id").alias("key"), "text", "lang")
    model = langid.fit(docs)
    for row in langid.predict(docs, model).collect():
        if row.lang_pred == "und":
            continue
        best, score = plain_nearest(model, row.text)
        assert row.lang_pred == model.languages[best] and abs(row.score - min(1.0, score)) < 1e-9
        n = len(langid._normal(row.text.lower().encode())).bit_length() - 1
        assert row.rejected == (score < model.floors[best, min(n, langid.LENGTHS - 1)] - langid.MARGIN)


def test_no_learned_text_is_rejected(spark):
    """Whatever the partitioning; no floor lies on a member's own cosine."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("doc_id").alias("key"), "text", "lang")
    labelled = docs.where(langid.has_letter(F.col("text")) & F.col("lang").isNotNull())
    models = [langid.fit(docs.repartition(n)) for n in (1, 5)]
    assert np.allclose(models[0].floors, models[1].floors, atol=1e-9)
    for model in models:
        for row in langid.predict(labelled, model).collect():
            assert not row.rejected
            best = model.languages.index(row.lang_pred)
            assert min(abs(row.score - f) for f in model.floors[best]) > 1e-9


def test_floors_change_smoothly_with_the_number_of_texts():
    cosine, lengths = np.full(300, 0.8), np.full(300, 9)
    floors = [langid.length_floors(cosine[:m], lengths[:m])[9] for m in range(1, 300)]
    assert all(0 <= b - a < 0.02 for a, b in zip(floors, floors[1:], strict=False)) and 0.4 < floors[0] < floors[-1] < 0.8


def test_a_batch_of_short_texts_needs_little_memory():
    import tracemalloc

    texts = [b"the cat sat on the mat"] * 10_000
    model = langid.Model(["en"], langid.unit(langid.counts(texts[:1]).astype(float)), np.zeros((1, langid.LENGTHS)), np.ones(langid.FEATURES))
    tracemalloc.start()
    best, score = model.nearest(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6 and score.min() > 0.999


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 2)
    docs = spark.createDataFrame([(i, "some text", f"l{i}") for i in range(3)], "key long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        langid.fit(docs)
