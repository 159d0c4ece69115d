"""Pseudonyms: a plain Python network, validity, linkage, and texts that must not change."""

import hashlib
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from folioscope.llm import private
from folioscope.llm.queries import QUERIES

KEY = "k1"


def plain_place(x, left, right, tweak, key=KEY):
    l, r = divmod(x, right)  # noqa: E741
    for i in range(private.HALF_ROUNDS):
        other = r if i % 2 == 0 else l
        drawn = int(hashlib.sha256(f"{key}|{tweak}|{i}|{other}".encode()).hexdigest()[:14], 16)
        l, r = ((l + drawn) % left, r) if i % 2 == 0 else (l, (r + drawn) % right)  # noqa: E741
    return l * right + r


def plain_characters(text, tweak, key=KEY):
    halves = [text[: len(text) // 2], text[len(text) // 2 :]]
    for i in range(private.HALF_ROUNDS):
        drawn = hashlib.sha512(f"{key}|{tweak}|{i}|{halves[1 - i % 2]}".encode()).hexdigest()
        out = ""
        for j, c in enumerate(halves[i % 2]):
            by = int(drawn[4 * j : 4 * j + 4], 16)
            for first, n in ((48, 10), (97, 26), (65, 26)):
                if first <= ord(c) < first + n and c.isascii():
                    c = chr(first + (ord(c) - first + by) % n)
                    break
            out += c
        halves[i % 2] = out
    return "".join(halves)


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else (2 * int(d) - 9 if d > "4" else 2 * int(d)) for i, d in enumerate(reversed(digits)))


def plain_iban(text):
    rest = plain_characters(text.replace(" ", "")[4:], "iban")
    number = int("".join(str(int(c, 36)) for c in rest + text[:2] + "00"))
    whole = f"{text[:2]}{98 - number % 97:02d}{rest}"
    return " ".join(whole[i : i + 4] for i in range(0, len(whole), 4)) if " " in text else whole


def plain_date(text):
    y, m, d = (int(x) for x in text.split("-"))
    first = date(1700, 1, 1)
    return str(first + timedelta(plain_place((date(y, m, d) - first).days, 773, 189, "date")))


def plain_card(digits):
    n = len(digits)
    low = (n - 2) // 2
    body = digits[0] + str(plain_place(int(digits[1:-1]), 10 ** (n - 2 - low), 10**low, f"card{n}")).zfill(n - 2)
    return body + str((10 - luhn(body + "0") % 10) % 10)


def plain_phone(text):
    d = re.sub(r"\D", "", text)[-10:]
    first, areas, start, n, name = (
        (200, 800, 200, 800, "phone") if d[0] > "1" and d[3] > "1" else (200, 800, 0, 200, "phone-low-exchange") if d[0] > "1" else (0, 200, 0, 1000, "phone-low-area")
    )
    v = plain_place(((int(d[:3]) - first) * n + int(d[3:6]) - start) * 10_000 + int(d[6:]), areas * n, 10_000, name)
    new = f"{v // n // 10_000 + first:03d}{v // 10_000 % n + start:03d}{v % 10_000:04d}"
    it = iter(("1" if text.startswith("+1") else "") + new)
    return re.sub(r"\d", lambda _: next(it), text)


def plain_ip(text):
    v = plain_place(int.from_bytes(bytes(map(int, text.split(".")))), 65_536, 65_536, "ip")
    return ".".join(map(str, v.to_bytes(4)))


def run(spark, texts, key=KEY):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.text, r.n_private, r.private_kinds) for r in private.pseudonymise(docs, key).orderBy("doc_id").collect()]


def test_against_plain_python(spark):
    email = "kfslg.71@mail0.example.com"
    cases = {
        email: plain_characters("kfslg.71", "email") + "@mail0.example.com",
        "+1 (578) 555-6437": plain_phone("+1 (578) 555-6437"),
        "+1 (139) 555-6437": plain_phone("+1 (139) 555-6437"),
        "(539) 055-6437": plain_phone("(539) 055-6437"),
        "415-555-2671": plain_phone("415-555-2671"),
        "4918187128635271": plain_card("4918187128635271"),
        "378282246310005": plain_card("378282246310005"),
        "42.144.35.254": plain_ip("42.144.35.254"),
        "2024-02-29": plain_date("2024-02-29"),
        "GB82 WEST 1234 5698 7654 32": plain_iban("GB82 WEST 1234 5698 7654 32"),
        "DE89370400440532013000": plain_iban("DE89370400440532013000"),
    }
    got = run(spark, [f"ab {v}, end" for v in cases])
    assert [t for t, _, _ in got] == [f"ab {v}, end" for v in cases.values()]
    assert all(n == 1 for _, n, _ in got)
    assert [k for _, _, k in got] == ["email", "phone", "phone", "phone", "phone", "card", "card", "ip", "date", "iban", "iban"]
    grouped = run(spark, ["4918-1871-2863-5271", "3782 822463 10005"])
    assert re.sub(r"\D", "", grouped[0][0]) == plain_card("4918187128635271") and re.fullmatch(r"(\d{4}-){3}\d{4}", grouped[0][0])
    assert re.sub(r"\D", "", grouped[1][0]) == plain_card("378282246310005") and re.fullmatch(r"\d{4} \d{6} \d{5}", grouped[1][0])


def test_values_next_to_each_other_and_linkage(spark):
    line = "kfslg.71@mail0.example.com +1 (269) 555-3296 4524132264652876 10.0.0.1."
    other = "x 4524132264652876"
    (a, n, kinds), (b, _, _) = run(spark, [line, other])
    assert n == 4 and kinds == "card,email,ip,phone"
    assert a.split()[-2] == b.split()[1] != "4524132264652876"
    assert run(spark, [line], "another key")[0][0] != a


@pytest.mark.parametrize("form", ["%d/%m/%Y", "%m/%d/%Y", "%d.%m.%Y"])
def test_written_dates(spark, form):
    from datetime import datetime

    days = [date(1990, 12, 13) + timedelta(i) for i in range(19)]
    got = [t for t, _, _ in run(spark, [d.strftime(form) for d in days])]
    assert len(set(got)) == len(days)
    for text in got:
        made = datetime.strptime(text, form)
        assert form != "%m/%d/%Y" or made.day > 12  # month first only where it cannot be read otherwise


@pytest.mark.parametrize("size", [(7, 5), (773, 189), (12, 12)])
def test_place_is_a_permutation(spark, size):
    n = size[0] * size[1]
    net = private.Network(KEY)
    rows = spark.range(min(n, 3000)).select(net.place(F.col("id"), *size, "t").alias("y")).collect()
    assert [r.y for r in rows] == [plain_place(x, *size, "t") for x in range(min(n, 3000))]
    assert len({r.y for r in rows}) == len(rows) and all(0 <= r.y < n for r in rows)


def test_social_numbers_stay_valid_and_distinct(spark):
    values = [f"{a:03d}-{g:02d}-{s:04d}" for a in (1, 665, 667, 899) for g in (1, 99) for s in (1, 9999)]
    got = [t for t, _, _ in run(spark, values)]
    assert len(set(got)) == len(values)
    assert all(re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", t) for t in got)


CLEAN = [
    None, "", "no data, 1 2 3", "Licensed under the Apache License, Version 2.0.", "4918187128635272", "300.1.2.3 and 1.2.3.4.5", "2023-02-30",
    "666-12-3456", "GB83 WEST 1234 5698 7654 32", "a@b", "12/13/14", "99/99/1999", "token = 0cab398dc11d1a2a11dc6572c8df8bd228c864f3",
    "178-155-6437", "1234567890123456789012", "é" * 10 + " 100.000 3.14159",
]


def test_clean_texts_stay(spark):
    assert [t for t, _, _ in run(spark, CLEAN)] == CLEAN
    assert all(n == 0 and k == "" for _, n, k in run(spark, CLEAN))


def test_edge_tables(spark):
    long = "word " * 40_000 + "a.b@example.org"
    docs = spark.createDataFrame([(1, long, 3), (1, long, 3)], "doc_id long, text string, n_private int")
    found = private.pseudonymise(docs, KEY)
    assert sorted(found.columns) == ["doc_id", "n_private", "private_kinds", "text"]
    rows = found.collect()
    assert len(rows) == 2 and all(r.text.startswith("word ") and r.n_private == 1 and "a.b@" not in r.text for r in rows)
    assert private.pseudonymise(docs.limit(0), KEY).collect() == []


def test_query(spark, data, documents, plan_of):
    query = QUERIES["op7_private"](spark, data)
    assert not re.search("Python|Pandas|Arrow", plan_of(query))
    texts = {d["doc_id"]: d["text"] for d in documents}
    rows = query.collect()
    assert len(rows) == len(texts)
    card = re.compile(r"(?<![\d.+])\d{16}(?!\d)")
    for row in rows:
        old = texts[row.doc_id]
        values = re.findall(r"[a-z]+\.\d\d@\S+\.com|\+1 \(\d{3}\) \d{3}-\d{4}|(?<![\d.])\d+\.\d+\.\d+\.\d+(?!\.?\d)", old)
        values += [c for c in card.findall(old) if luhn(c) % 10 == 0]
        assert (row.n_private == len(values)) and (row.n_private > 0) == (row.text != old), (values, row.n_private)
        assert not any(v in row.text for v in values)
        assert re.sub(r"[\da-z.]", "", row.text) == re.sub(r"[\da-z.]", "", old)


def test_each_form_alone_in_a_text(spark):
    alone = ["+45 12 34 56 78", "+45-12-34-56-78", "+44 20 79 46 09 58", "a@b.de", "1.2.3.4", "1/2/1999", "2024-02-29", "123-45-6789"]
    got = run(spark, alone)
    assert [n for _, n, _ in got] == [1] * len(alone)
    assert not any(t == v for (t, _, _), v in zip(got, alone, strict=True))
    (a, _, _), (b, _, _) = run(spark, [f"call {alone[0]}", f"call {alone[0]} room 4711"])
    assert b == f"{a} room 4711"  # equal values stay linked


def test_account_numbers_before_other_words_and_values(spark):
    alone = ["BE68539007547034", "BE68 5390 0754 7034", "AT611904300234573201", "ES9121000418450200051332", "GB82 WEST 1234 5698 7654 32"]
    after = [" EUR 500", " PAID", " 2024", " AB", ". X", " BE68539007547034"]
    for tail in after[:-1]:
        assert [t for t, _, _ in run(spark, [v + tail for v in alone])] == [plain_iban(v) + tail for v in alone]
    got = run(spark, [v + after[-1] for v in alone])
    assert [(t, n) for t, n, _ in got] == [(f"{plain_iban(v)} {plain_iban(alone[0])}", 2) for v in alone]


def test_values_behind_what_is_no_account_number(spark):
    phone, card, mail = "415-555-2671", "4918 1871 2863 5271", "KFSLG@mail0.example.com"
    got = run(spark, [f"REF AB12 CDEF GHIJ {v}" for v in (phone, card, mail, "BE68 5390 0754 7034")])
    assert [k for _, _, k in got] == ["phone", "card", "email", "iban"]
    assert got[0][0] == f"REF AB12 CDEF GHIJ {plain_phone(phone)}" and got[3][0] == f"REF AB12 CDEF GHIJ {plain_iban('BE68 5390 0754 7034')}"
    mark = private._MARK
    (text, n, _), (same, none, _) = run(spark, [f"{mark}x BE68539007547034{mark} a {phone}", f"a{mark} {mark}12"])
    assert (text, n) == (f"{mark}x {plain_iban('BE68539007547034')}{mark} a {plain_phone(phone)}", 2)
    assert (same, none) == (f"a{mark} {mark}12", 0)
