"""Personal data in documents, replaced by keyed pseudonyms of the same format. DataFrame functions only.

Method: one pattern finds account numbers, another all other candidates in what is left; each is validated (check digits, ranges, calendar) and mapped to its place in the set of
all valid values of its format. A Feistel network over that set, keyed by hashes, permutes it, and the new place is
written in the found value's format. So equal values get equal pseudonyms in all documents, different values different ones.

| kind | valid | what is permuted |
| --- | --- | --- |
| email | address | the letters and digits before the @, each within its class |
| phone | ten digits with +1 or brackets, others with area and exchange from 200; other countries after + | the ten digits, apart for those in and below these ranges; the digits after the country code |
| card | 13 to 19 digits, plain or in card groups, Luhn | all digits but the first; the last is the new check digit |
| ip | four numbers to 255 | the 32 bits |
| ssn | area 001-899 without 666, group 01-99, serial 0001-9999 | place in that set |
| iban | country, check digits modulo 97 | letters and digits after the check digits, each within its class; new check digits |
| date | calendar, years 1700 to 2099; y-m-d, d/m/y, m/d/y (with / or .) | day of the 400-year cycle, an exact 146,097 days |

d/m/y is tried before m/d/y; a date that is only valid as m/d/y walks on along its cycle until it is such a date again, so the two
do not mix. An account number has the length that its country fixes; of other countries it is the longest run of groups. What
is no valid account number is searched for the other kinds like the text around it. Everything else, and every value that is not valid, stays as it is, byte by byte. A permutation may map a value to itself; of sets as
large as these hardly ever one does (a local part of one letter may, as 1 in 26).

Null texts stay null, empty ones empty; both count no values. Whole texts are read. Repeated rows are treated alike. Extra columns
pass through; one with the name of an output is replaced.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Half-rounds of every network.
HALF_ROUNDS = 8

#: Steps that a date which must be written month first walks at most; each ends with a chance of 0.6.
WALK = 24

_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])"
_PHONE = r"(?:(?<![\d+])\+1[ .-]?)?(?<!\d)(?:\(\d{3}\) ?|(?<=\+1)\d{3}[ .-]?|(?<=\+1[ .-])\d{3}[ .-]?|\d{3}[ .-])\d{3}[ .-]?\d{4}(?!\d)"
_ABROAD = r"(?<![\d+])\+[2-9]\d{0,2}(?:[ .-]?\(?\d{2,4}\)?){2,4}(?!\d)"
_CARD = r"(?<![\d.+])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)"
_IP = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
#: Characters of an account number, as each country fixes them.
_IBAN_SIZES = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV", 22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA",
    23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST", 26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM",
    28: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU",
}


def _iban_of(size: int, countries: str) -> str:
    groups, rest = divmod(size - 4, 4)
    return rf"(?:{countries})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}" + (rf" ?[A-Z0-9]{{{rest}}}" if rest else "")


_KNOWN = "|".join(_IBAN_SIZES.values())
#: Other countries, and unusual lengths; a word like the head of a known country's number ends these.
_OTHER_IBAN = rf"[A-Z]{{2}}\d{{2}}(?: ?(?!\b(?:{_KNOWN})\d\d)[A-Z0-9]{{4}}){{2,7}}(?: ?(?!\b(?:{_KNOWN})\d)[A-Z0-9]{{1,3}})?"
_EACH_IBAN = [*(_iban_of(*each) for each in _IBAN_SIZES.items()), _OTHER_IBAN]
_IBAN = r"\b(?:" + "|".join(rf"{each}\b" for each in _EACH_IBAN) + r")(?![A-Za-z0-9._%+-]{0,63}@)"
_DATE = r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d/-]|\.\d)"
CANDIDATE = "|".join([_EMAIL, _DATE, _IP, _SSN, _PHONE, _ABROAD, _CARD])

#: Stands for an account number while the other kinds are searched; one in the text itself stands for itself.
_MARK = "\ue000"

_NANP = r"^((?:\+1[ .-]?)?\(?)(\d{3})(\)?[ .-]?)(\d{3})([ .-]?)(\d{4})$"
_FIRST_DAY, _DAYS = "1700-01-01", 146_097


def _number(hexadecimal: Column) -> Column:
    return F.conv(hexadecimal, 16, 10).cast("long")


def _div(x: Column, by: int) -> Column:
    """Whole-number division of a long, exact also beyond what a double holds."""
    return F.call_function("div", x, F.lit(by).cast("long"))


class Network:
    """Permutations keyed by ``key``; each format (``tweak``) has its own."""

    def __init__(self, key: str):
        self.key = key

    def _hash(self, tweak: str, half: Column, value: Column, bits: int = 256) -> Column:
        return F.sha2(F.concat_ws("|", F.lit(self.key), F.lit(tweak), half.cast("string"), value.cast("string")), bits)

    def place(self, x: Column, left: int, right: int, tweak: str) -> Column:
        """Another place in 0 to left * right - 1: halves are added to, in turn, what a hash of the other half gives."""
        low = F.pmod(x, F.lit(right).cast("long"))
        start = F.struct(_div(x - low, right).alias("l"), low.alias("r"))

        def half(state: Column, i: Column) -> Column:
            even = i % 2 == 0
            drawn = _number(F.substring(self._hash(tweak, i, F.when(even, state["r"]).otherwise(state["l"])), 1, 14))
            return F.struct(
                F.when(even, (state["l"] + drawn) % left).otherwise(state["l"]).alias("l"),
                F.when(even, state["r"]).otherwise((state["r"] + drawn) % right).alias("r"),
            )

        turns = F.sequence(F.lit(0), F.lit(HALF_ROUNDS - 1))
        return F.aggregate(turns, start, half, lambda s: s["l"] * F.lit(right).cast("long") + s["r"])

    def characters(self, text: Column, tweak: str) -> Column:
        """A string of the same form: digits, small and capital letters change within their class, all else stays."""
        size = F.length(text)
        middle = F.floor(size / 2).cast("int")
        start = F.struct(F.substring(text, F.lit(1), middle).alias("l"), F.substring(text, middle + 1, size).alias("r"))

        def shifted(part: Column, drawn: Column) -> Column:
            def one(c: Column, i: Column) -> Column:
                code, by = F.ascii(c), _number(F.substring(drawn, i * 4 + 1, F.lit(4)))
                turn = lambda first, n: F.char(F.lit(first) + (code - first + by) % n)
                return (
                    F.when(c.rlike("^[0-9]$"), turn(48, 10)).when(c.rlike("^[a-z]$"), turn(97, 26)).when(c.rlike("^[A-Z]$"), turn(65, 26)).otherwise(c)
                )

            return F.array_join(F.transform(F.split(part, ""), one), "")

        def half(state: Column, i: Column) -> Column:
            even = i % 2 == 0
            drawn = self._hash(tweak, i, F.when(even, state["r"]).otherwise(state["l"]), 512)
            return F.struct(
                F.when(even, shifted(state["l"], drawn)).otherwise(state["l"]).alias("l"),
                F.when(even, state["r"]).otherwise(shifted(state["r"], drawn)).alias("r"),
            )

        turns = F.sequence(F.lit(0), F.lit(HALF_ROUNDS - 1))
        return F.aggregate(turns, start, half, lambda s: F.concat(s["l"], s["r"]))


def _fold(text: Column, step: Callable[[Column, Column], Column], zero: Column) -> Column:
    return F.aggregate(F.split(text, ""), zero, step)


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits, the last one counted once."""
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    each = F.transform(
        F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, doubled(F.ascii(c) - 48)).otherwise(F.ascii(c) - 48)
    )
    return F.aggregate(each, F.lit(0), lambda a, d: a + d)


def mod97(text: Column) -> Column:
    """An account number modulo 97, letters counted as 10 to 35."""
    step = lambda a, c: F.when(c.rlike("^[0-9]$"), a * 10 + F.ascii(c) - 48).otherwise(a * 100 + F.ascii(c) - 55) % 97
    return _fold(text, step, F.lit(0))


def _groups(m: Column, pattern: str, n: int) -> list[Column]:
    return [F.regexp_extract(m, pattern, i) for i in range(1, n + 1)]


def _padded(x: Column, width: int) -> Column:
    return F.lpad(x.cast("string"), width, "0")


def _email(m: Column, net: Network) -> tuple[Column, Column]:
    at = F.regexp_extract(m, r"^([^@]*)@(.*)$", 1)
    return m.rlike(f"^{_EMAIL}$"), F.concat(net.characters(at, "email"), F.lit("@"), F.regexp_extract(m, r"^([^@]*)@(.*)$", 2))


#: Sets of ten-digit numbers: first area and its number, first exchange and its number, name. Each is permuted within itself.
_PHONE_SETS = [(200, 800, 200, 800, "phone"), (0, 200, 0, 1000, "phone-low-area"), (200, 800, 0, 200, "phone-low-exchange")]


def _phone(m: Column, net: Network) -> tuple[Column, Column]:
    head, area, between, exchange, dash, line = _groups(m, _NANP, 6)

    def within(first: int, areas: int, start: int, exchanges: int, name: str) -> tuple[Column, Column]:
        def number(v: Column) -> Column:
            new_area, new_exchange = _div(v, exchanges * 10_000) + first, _div(v, 10_000) % exchanges + start
            return F.concat(head, _padded(new_area, 3), between, _padded(new_exchange, 3), dash, _padded(v % 10_000, 4))

        x = ((area.cast("long") - first) * exchanges + exchange.cast("long") - start) * 10_000 + line.cast("long")
        held = area.cast("int").between(first, first + areas - 1) & exchange.cast("int").between(start, start + exchanges - 1)
        return held, F.transform(F.array(net.place(x, areas * exchanges, 10_000, name)), number)[0]

    written = F.coalesce(*[F.when(*within(*each)) for each in _PHONE_SETS])
    in_range = area.rlike("^[2-9]") & exchange.rlike("^[2-9]")
    return m.rlike(_NANP) & (in_range | m.rlike(r"^(?:\+|\()")), written


def _abroad(m: Column, net: Network) -> tuple[Column, Column]:
    head, rest = _groups(m, r"^(\+[2-9]\d{0,2}?(?=[ .(-]|\d{7}))(.*)$", 2)
    return m.rlike(f"^{_ABROAD}$") & (F.length(rest) > 0) & (F.length(F.regexp_replace(m, r"\D", "")) >= 8), F.concat(head, net.characters(rest, "abroad"))


def _card(m: Column, net: Network) -> tuple[Column, Column]:
    digits = F.regexp_replace(m, "[ -]", "")
    separator = F.regexp_extract(m, "[ -]", 0)
    size = F.length(digits)
    plain = digits
    for n in range(13, 20):  # each length is a format of its own
        body = F.substring(digits, 2, n - 2)
        low = (n - 2) // 2
        y = _padded(net.place(body.cast("long"), 10 ** (n - 2 - low), 10**low, f"card{n}"), n - 2)
        plain = F.when(size == n, F.concat(F.substring(digits, 1, 1), y)).otherwise(plain)
    whole = F.transform(F.array(plain), lambda p: F.concat(p, ((10 - luhn_sum(F.concat(p, F.lit("0"))) % 10) % 10).cast("string")))[0]
    by_four = F.regexp_replace(whole, r"^(\d{4})(\d{4})(\d{4})(\d{4})$", "$1-$2-$3-$4")
    grouped = F.when(m.rlike(r"^\d{4}[ -]\d{6}"), F.regexp_replace(whole, r"^(\d{4})(\d{6})(\d{5})$", "$1-$2-$3")).otherwise(by_four)
    valid = m.rlike(f"^(?:{_CARD})$") & digits.rlike(r"^\d{13,19}$") & ~digits.rlike("^0+$")
    return valid & F.when(valid, luhn_sum(digits) % 10 == 0).otherwise(False), F.when(separator == "", whole).otherwise(
        F.replace(grouped, F.lit("-"), separator)
    )


def _ip(m: Column, net: Network) -> tuple[Column, Column]:
    parts = F.transform(F.split(m, r"\."), lambda p: p.cast("long"))
    y = net.place(F.aggregate(parts, F.expr("0L"), lambda a, p: a * 256 + p), 65_536, 65_536, "ip")
    octet = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    written = F.transform(
        F.array(y),
        lambda v: F.concat_ws(".", *[(F.shiftright(v, s).bitwiseAND(F.expr("255L"))).cast("string") for s in (24, 16, 8, 0)]),
    )[0]
    return m.rlike(rf"^{octet}(?:\.{octet}){{3}}$"), written


def _ssn(m: Column, net: Network) -> tuple[Column, Column]:
    area, group, serial = (c.cast("long") for c in _groups(m, r"^(\d{3})-(\d{2})-(\d{4})$", 3))
    x = ((area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1) * 9_999 + serial - 1
    y = net.place(x, 898 * 99, 9_999, "ssn")

    def written(v: Column) -> Column:
        first = _div(v, 99 * 9_999)
        return F.concat_ws(
            "-",
            _padded(first + F.when(first >= 665, 2).otherwise(1), 3),
            _padded(_div(v, 9_999) % 99 + 1, 2),
            _padded(v % 9_999 + 1, 4),
        )

    return m.rlike(r"^(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}$"), F.transform(F.array(y), written)[0]


def _iban(m: Column, net: Network) -> tuple[Column, Column]:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    country, rest = F.substring(plain, 1, 2), F.substring(plain, 5, 34)
    other = net.characters(rest, "iban")
    whole = F.transform(
        F.array(other), lambda o: F.concat(country, _padded(98 - mod97(F.concat(o, country, F.lit("00"))), 2), o)
    )[0]
    valid = m.rlike(f"^{_IBAN}$")
    right = F.when(valid, mod97(F.concat(rest, F.substring(plain, 1, 4))) == 1).otherwise(False)
    return right, F.when(m.contains(" "), F.regexp_replace(whole, "(.{4})(?=.)", "$1 ")).otherwise(whole)


def _day(year: Column, month: Column, day: Column) -> Column:
    """Day of the cycle from 1700 to 2099, or null."""
    date = F.try_to_timestamp(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), F.lit("yyyy-MM-dd")).cast("date")
    within = year.rlike("^(?:1[7-9]|20)") & (month.rlike("^(?:0?[1-9]|1[0-2])$")) & (day.rlike("^(?:0?[1-9]|[12][0-9]|3[01])$"))
    return F.when(within, F.datediff(date, F.lit(_FIRST_DAY).cast("date")))


def _date(m: Column, net: Network) -> tuple[Column, Column]:
    iso = m.rlike("^[0-9]{4}-")
    y, mo, d = _groups(m, r"^(\d{4})-(\d{2})-(\d{2})$", 3)
    a, separator, b, c = _groups(m, r"^(\d{1,2})([/.])(\d{1,2})[/.](\d{4})$", 4)
    whole, first, month = _day(y, mo, d), _day(c, b, a), _day(c, a, b)
    step = lambda x: net.place(x.cast("long"), 773, 189, "date")  # noqa: E731  773 * 189 days are the cycle
    as_date = lambda x: F.date_add(F.lit(_FIRST_DAY).cast("date"), x.cast("int"))
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        step(month),
        lambda x, _: F.when(F.dayofmonth(as_date(x)) > 12, x).otherwise(step(x)),
    )
    written = lambda x, form: F.date_format(as_date(x), form)
    slashed = F.when(first.isNotNull(), written(step(first), "dd/MM/yyyy")).otherwise(written(walked, "MM/dd/yyyy"))
    return F.coalesce(whole, first, month).isNotNull(), F.when(iso, written(step(whole), "yyyy-MM-dd")).otherwise(
        F.replace(slashed, F.lit("/"), separator)
    )


#: Kinds but account numbers, in the order in which a candidate is tried.
KINDS: dict[str, Callable[[Column, Network], tuple[Column, Column]]] = {
    "email": _email, "date": _date, "ip": _ip, "ssn": _ssn, "phone": _phone, "abroad": _abroad, "card": _card,
}


def _replaced(m: Column, net: Network) -> Column:
    """A struct of the value to write and the kind found (null: none)."""
    value = None
    for name, rule in KINDS.items():
        valid, new = rule(m, net)
        label = F.lit("phone" if name == "abroad" else name)
        found = F.struct(new.alias("new"), label.alias("kind"))
        value = F.when(valid, found) if value is None else value.when(valid, found)
    return value.otherwise(F.struct(m.alias("new"), F.lit(None).cast("string").alias("kind")))


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Replaces personal data in the text column; adds n_private (values replaced) and private_kinds (sorted, comma-joined)."""
    net = Network(key)
    body = F.col(text)
    some = body.rlike("[0-9]{3}|@|[0-9][./][0-9]|[+][2-9]|[A-Z]{2}[0-9]{2}")  # every candidate has one of these

    def account(m: Column) -> Column:
        valid, new = _iban(m, net)
        found = F.struct(new.alias("new"), F.lit("iban").alias("kind"), F.lit(_MARK).alias("left"))
        return F.when(valid, found).otherwise(F.struct(m.alias("new"), F.lit(None).cast("string").alias("kind"), m.alias("left")))

    def matches(column: Column, pattern: str) -> Column:
        return F.regexp_extract_all(column, F.lit(pattern), F.lit(0))

    def put(column: Column, pattern: str, news: Column) -> Column:
        parts = F.split(column, pattern, -1)
        return F.array_join(F.zip_with(parts, F.array_append(news, F.lit("")), lambda a, b: F.concat(a, b)), "")

    accounts = f"{_MARK}|{_IBAN}"
    found = docs.withColumn("_accounts", F.when(some, F.transform(matches(body, accounts), account)))
    found = found.withColumn("_rest", F.when(F.size("_accounts") > 0, put(body, accounts, F.transform("_accounts", lambda f: f["left"]))).otherwise(body))
    rest = F.col("_rest")
    found = found.withColumn("_found", F.when(some, F.transform(matches(rest, CANDIDATE), lambda m: _replaced(m, net))))
    marked = F.filter("_accounts", lambda f: f["left"] == _MARK)
    written = put(rest, CANDIDATE, F.transform("_found", lambda f: f["new"]))
    written = F.when(F.size(marked) > 0, put(written, _MARK, F.transform(marked, lambda f: f["new"]))).otherwise(written)
    each = F.concat(F.transform("_accounts", lambda f: f["kind"]), F.transform("_found", lambda f: f["kind"]))
    kinds = F.filter(each, lambda k: k.isNotNull())
    changed = F.size(kinds) > 0
    return (
        found.withColumn("n_private", F.coalesce(F.size(kinds), F.lit(0)).cast("long"))
        .withColumn("private_kinds", F.coalesce(F.array_join(F.array_sort(F.array_distinct(kinds)), ","), F.lit("")))
        .withColumn(text, F.when(changed, written).otherwise(body))
        .drop("_accounts", "_rest", "_found")
    )
