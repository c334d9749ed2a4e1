"""Masking against a plain masker, and the one-to-one promise of dates and telephone numbers."""

from __future__ import annotations

import hashlib
import random
import re as plain_re
from datetime import date, datetime, timedelta

import pytest
import regex
from pyspark.sql import functions as F

from quarterdeck.llm import pii

KEY = "k"


def h(kind, *parts):
    return hashlib.sha256("|".join([KEY, kind, *map(str, parts)]).encode()).hexdigest()


def network(left, right, a, b, add):
    for i in range(1, 9):
        if i % 2:
            left = (left + int(add(i, right)[:15], 16)) % a
        else:
            right = (right + int(add(i, left)[:15], 16)) % b
    return left, right


def feistel(kind, x, a, b):
    left, right = network(x // b, x % b, a, b, lambda i, half: h(kind, i, half))
    return left * b + right


def digits(kind, d):
    n, low = len(d), len(d) // 2
    left, right = network(int(d[: n - low]), int(d[n - low :]), 10 ** (n - low), 10**low, lambda i, half: h(kind, n, i, half))
    return f"{left:0{n - low}}{right:0{low}}"


def refill(shape, new):
    left = iter(new)
    return "".join(next(left) if c in "0123456789" else c for c in shape)


def luhn(d):
    return sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(map(int, reversed(d)))) % 10


def card(m):
    d = plain_re.sub("[^0-9]", "", m)
    if luhn(d) == 0:
        body = digits("card", d[:-1])
        return refill(m, body + str((10 - luhn(body + "0")) % 10))


EVERY = [date(1900, 1, 1) + timedelta(k) for k in range(73049)]
LATER = [d for d in EVERY if d.day > 12]
EARLIER = [d for d in EVERY if d.day <= 12]


def day(m):
    text = plain_re.sub("[/.]", "-", m)
    for layout in ["%Y-%m-%d"] if text[:4].isdigit() else ["%d-%m-%Y", "%m-%d-%Y"]:
        try:
            d = datetime.strptime(text, layout).date()
        except ValueError:
            continue
        if d.day <= 12:
            new = EARLIER[feistel("date 1-12", EARLIER.index(d), 160, 180)]
        else:
            k = feistel("date 13-31", LATER.index(d), 250, 177)
            new = LATER[k if k < len(LATER) else feistel("date 13-31", k, 250, 177)]
        return new.strftime(layout).replace("-", plain_re.search("[-/.]", m)[0])


def ssn(m):
    areas = [a for a in range(1, 900) if a != 666]
    a, g, s = map(int, m.split("-"))
    v = feistel("ssn", (areas.index(a) * 99 + g - 1) * 9999 + s - 1, 898 * 99, 9999)
    return f"{areas[v // (99 * 9999)]:03}-{v // 9999 % 99 + 1:02}-{v % 9999 + 1:04}"


def ipv4(m):
    v = feistel("ipv4", int.from_bytes(map(int, m.split("."))), 65536, 65536)
    return ".".join(map(str, v.to_bytes(4)))


def phone(m):
    head = ""
    if m[0] == "+":
        two = "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
        head = m[:2] if m[1] in "017" else m[:3] if m[1:3] in two else plain_re.match("[+][0-9]{1,3}", m)[0]
    rest = m[len(head) :]
    d = plain_re.sub("[^0-9]", "", rest)
    if len(d) <= 15 and len(d) + len(head[1:]) >= 7:
        return head + refill(rest, digits("phone", d))


MAKERS = {"email": lambda m: f"u{h('email', m.lower())[:16]}@pseudonym.invalid", "secret": lambda m: h("secret", m)[: len(m)], "ipv4": ipv4, "date": day, "ssn": ssn, "phone": phone, "card": card, "iban": lambda m: None}


def masked(text):
    """The text and the kinds replaced; what looks like an account number in these texts is none."""
    kinds = []

    def swap(m):
        kind = next(k for k, p in pii.PATTERNS.items() if regex.fullmatch(p, m[0]))
        new = MAKERS[kind](m[0])
        if new is not None:
            kinds.append(kind)
        return m[0] if new is None else new

    return regex.sub(pii.ANY, swap, text), kinds


def test_masking_is_that_of_a_plain_masker(spark):
    rng = random.Random(5)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    valid = lambda n: next(d for d in (number(n) for _ in range(1000)) if luhn(d) == 0)
    d = lambda: rng.choice(EVERY)
    makers = [
        lambda: d().strftime(rng.choice(["%Y-%m-%d", "%d.%m.%Y", "%m/%d/%Y", "%d/%m/%Y"])), lambda: f"{rng.randint(1900, 2099)}-{rng.randint(0, 19):02}-{rng.randint(0, 39):02}",
        lambda: valid(rng.randint(13, 19)), lambda: number(16), lambda: " ".join(plain_re.findall("....", valid(16))), lambda: f"{number(3)}-{number(2)}-{number(4)}",
        lambda: ".".join(str(rng.randint(0, 270)) for _ in range(4)), lambda: f"+{rng.randint(1, 999)} {number(3)} {number(4)} {number(3)}", lambda: f"+{number(rng.randint(6, 15))}",
        lambda: f"({number(3)}) {number(3)}-{number(4)}", lambda: f"{number(3)}.{number(3)}.{number(4)}", lambda: f"a.{number(3)}@Site{number(1)}.example.com", lambda: rng.randbytes(rng.randint(14, 34)).hex(),
        lambda: rng.choice(["word", "naïve", "x@y", "12", "+", "\n", "日本", "", "3.14", "1,000"]),
    ]
    texts = [rng.choice([" ", ", ", "; "]).join(rng.choice(makers)() for _ in range(rng.randint(0, 12))) for _ in range(600)]
    rows = pii.mask(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), KEY).collect()
    seen = set()
    for r in rows:
        assert (r.text, r._pii_kinds) == masked(texts[r.doc_id])
        seen.update(r._pii_kinds)
    assert len(rows) == len(texts) and seen == set(MAKERS) - {"iban"}


def test_dates_have_as_many_pseudonyms_as_values_and_one_in_all_layouts(spark):
    """Every date in every layout in which it is read as itself."""
    first = F.lit("1900-01-01").cast("date")
    dates = spark.range(73049).select(F.date_add(first, F.col("id").cast("int")).alias("d"))
    layouts = [("yyyy-MM-dd", "true"), ("dd/MM/yyyy", "true"), ("MM/dd/yyyy", "dayofmonth(d) > 12")]
    given = None
    for layout, where in layouts:
        some = dates.where(where).select("d", F.lit(layout).alias("layout"), F.date_format("d", layout).alias("m"))
        given = some if given is None else given.union(some)
    made = given.repartition(8).select("*", pii._date(KEY, F.col("m")).alias("p"))
    back = F.coalesce(*[F.when(F.col("layout") == layout, F.to_date("p", layout)) for layout, _ in layouts])
    n, values, pseudonyms, pairs = made.agg(F.count("*"), F.countDistinct("m"), F.countDistinct("p"), F.countDistinct("d", back)).first()
    assert n == values == pseudonyms == 2 * 73049 + 44249 and pairs == 73049


@pytest.mark.parametrize("code", ["1", "49", "971"])
def test_telephone_numbers_are_linked_and_keep_their_country(spark, code):
    forms = [f"+{code} 30 1234567", f"+{code}301234567", f"+{code}-30-1234-567", f"+{code} (30) 123 4567"]
    got = [r.text for r in pii.mask(spark.createDataFrame(list(enumerate(forms)), "doc_id long, text string"), KEY).orderBy("doc_id").collect()]
    bare = {plain_re.sub("[^+0-9]", "", g) for g in got}
    assert len(bare) == 1 and bare.pop().startswith(f"+{code}") and all(g != f and plain_re.sub("[0-9]", "0", g) == plain_re.sub("[0-9]", "0", f) for g, f in zip(got, forms))
