"""Personal data replaced by format-preserving pseudonyms, in DataFrame operations only.

Numbers and dates that pass their format's validation are permuted by a keyed Feistel network over exactly the values of
the format: a value x of a domain of a * b values is a pair (x div b, x mod b), and each round adds a keyed hash of one
half to the other. Equal values therefore have equal pseudonyms in every document, different ones different pseudonyms,
and separators, lengths and check digits stay right. E-mail addresses and secrets have no such domain and take keyed
hashes of their own shape.

==========  ==========================================================  ==================================================
kind        what counts                                                 pseudonym
==========  ==========================================================  ==================================================
card        13-19 digits, plain or grouped, Luhn sum right              all but the last digit permuted, the last right
iban        mod-97 check right, and the length where it is known        digits and letters permuted by class, check right
date        calendar date of 1900-2099; Y-M-D, D-M-Y, else M-D-Y        date of 1900-2099, same layout and side of the 12th
ssn         AAA-GG-SSSS with valid area, group and serial               the same
ipv4        four octets                                                 four octets
phone       + and country code, or 3-3-4 digits with separators         digits behind the country code permuted
email       local@domain.tld                                            keyed hash in a reserved domain
secret      32 to 64 lower-case hex digits, letters and digits mixed    keyed hash of the same length
==========  ==========================================================  ==================================================

A date has one pseudonym in all layouts, and a phone number one with and without separators. A bare run of ten digits is no
phone number by itself. Patterns repeat single characters only, or a bounded number of
times, so that they take linear time and a bounded stack over texts of any length.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm.common import fresh_names, read_table

ROUNDS = 8
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_D2, _YEAR = "[0-3][0-9]", "(?:19|20)[0-9]{2}"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-][A-Za-z0-9.-]*\.[A-Za-z]{2,}",
    "secret": r"(?<![0-9A-Za-z])(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])[0-9a-f]{32,64}(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])(?:[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?|[a-z]{2}[0-9]{2}[a-z0-9]{11,30})(?![0-9A-Za-z])",
    "ipv4": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9])",
    "date": "(?<![0-9])(?:" + "|".join(f"{_YEAR}{s}{_D2}{s}{_D2}|{_D2}{s}{_D2}{s}{_YEAR}" for s in ("-", "/", r"\.")) + ")(?![0-9])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}|\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4})(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# The lengths of account numbers by country, as the public register of ISO 13616 has them.
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 "
    "IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 "
    "SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
)
# Country codes of one and two digits, as E.164 assigns them; all others have three. None starts with 0, which stays, as do the digits before an early separator.
COUNTRY_CODES = "0|1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{1,3}"
# 2,400 months of 1900 to 2099: 28,800 = 160 * 180 days up to the 12th of one, and one less than 250 * 177 later ones.
FIRST_DAY, EARLY, LATE = "1900-01-01", (160, 180), (250, 177)


def keyed(key: str, kind: str, *parts: Column) -> Column:
    """64 hex digits that depend on the key, the kind and the parts."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), *parts), 256)


def feistel(key: str, kind: str, x: Column, a: Column, b: Column) -> Column:
    """A keyed permutation of 0 .. a * b - 1, by rounds that add to one half a hash of the other."""

    def step(acc: Column, i: Column) -> Column:
        left, right = acc["l"], acc["r"]
        add = lambda half, m: F.pmod(F.conv(F.substring(keyed(key, kind, i.cast("string"), half.cast("string")), 1, 15), 16, 10).cast("long"), m)
        odd = i % 2 == 1
        return F.struct(F.when(odd, (left + add(right, a)) % a).otherwise(left).alias("l"), F.when(odd, right).otherwise((right + add(left, b)) % b).alias("r"))

    start = F.struct(F.floor(x / b).cast("long").alias("l"), (x % b).cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda acc: acc["l"] * b + acc["r"])


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced by these, in order."""
    each = lambda i: F.when(F.substring(shape, i, F.lit(1)).rlike("[0-9]"), F.substring(digits, F.length(_digits(F.substring(shape, F.lit(1), i))), F.lit(1))).otherwise(F.substring(shape, i, F.lit(1)))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(shape)), each), "")


def permute_digits(key: str, kind: str, d: Column, tweak: Column | None = None) -> Column:
    """A digit string of 2 to 18 digits permuted among those of its length, another way for each tweak."""
    more = [] if tweak is None else [tweak]
    n = F.length(d)
    low = F.floor(n / 2)
    a, b = F.round(F.pow(F.lit(10.0), n - low)).cast("long"), F.round(F.pow(F.lit(10.0), low)).cast("long")
    left, right = F.substring(d, F.lit(1), (n - low).cast("int")).cast("long"), F.substring(d, (n - low + 1).cast("int"), low.cast("int")).cast("long")

    def step(acc: Column, i: Column) -> Column:
        add = lambda half, m: F.pmod(F.conv(F.substring(keyed(key, kind, n.cast("string"), i.cast("string"), half.cast("string"), *more), 1, 15), 16, 10).cast("long"), m)
        odd = i % 2 == 1
        return F.struct(F.when(odd, (acc["l"] + add(acc["r"], a)) % a).otherwise(acc["l"]).alias("l"), F.when(odd, acc["r"]).otherwise((acc["r"] + add(acc["l"], b)) % b).alias("r"))

    start = F.struct(left.alias("l"), right.alias("r"))
    text = lambda v, w: F.lpad(v.cast("string"), w.cast("int"), "0")
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda acc: F.concat(text(acc["l"], n - low), text(acc["r"], low)))


def luhn_sum(d: Column) -> Column:
    """The Luhn sum of a digit string whose last digit is the check digit."""
    n = F.length(d)

    def add(acc: Column, i: Column) -> Column:
        v = F.substring(d, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return acc + v - F.when(v > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def mod97(s: Column) -> Column:
    """The ISO 7064 remainder of letters and digits; letters count 10 to 35."""
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)

    def add(acc: Column, i: Column) -> Column:
        v = value(F.substring(s, i, F.lit(1)))
        return (acc * F.when(v > 9, 100).otherwise(10) + v) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), add)


def _card(key: str, m: Column) -> Column:
    d = _digits(m)
    body = permute_digits(key, "card", F.substring(d, F.lit(1), F.length(d) - 1))
    full = F.transform(F.array(body), lambda p: F.concat(p, ((10 - luhn_sum(F.concat(p, F.lit("0"))) % 10) % 10).cast("string")))[0]
    return F.when(luhn_sum(d) % 10 == 0, _refill(m, full))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _shift_letters(key: str, letters: Column, tweak: Column) -> Column:
    """A string of at most 32 capitals, each moved by a keyed hash of the tweak and its place."""
    each = lambda h: lambda i: F.char(F.lit(65) + F.pmod(F.ascii(F.substring(letters, i, F.lit(1))) - 65 + F.conv(F.substring(h, 2 * i - 1, F.lit(2)), 16, 10).cast("int"), F.lit(26)))
    moved = _let(keyed(key, "letters", tweak), lambda h: F.array_join(F.transform(F.sequence(F.lit(1), F.length(letters)), each(h)), ""))
    return F.when(F.length(letters) > 0, moved).otherwise("")


def _account(key: str, rest: Column) -> Column:
    """The capitals and digits behind an account number's check digits, permuted by class: a Feistel network of both as halves."""
    letters, digits = F.regexp_replace(rest, "[^A-Z]", ""), _digits(rest)
    n = F.length(digits)
    low = F.floor(n / 2).cast("int")

    def permuted(first: Column) -> Column:  # the digits, given the letters of the first round
        a, b = F.substring(digits, F.lit(1), n - low), F.substring(digits, n - low + 1, low)
        two = _let(permute_digits(key, "iban", a, F.concat_ws("|", first, b)), lambda x: F.concat(x, permute_digits(key, "iban", b, F.concat_ws("|", first, x))))
        return F.when(n > 18, two).when(n >= 2, permute_digits(key, "iban", digits, first)).otherwise(digits)

    def filled(d: Column, l: Column) -> Column:
        taken = lambda i, kind, of: F.substring(of, F.length(F.regexp_replace(F.substring(rest, F.lit(1), i), kind, "")), F.lit(1))
        each = lambda i: F.when(F.substring(rest, i, F.lit(1)).rlike("[0-9]"), taken(i, "[^0-9]", d)).otherwise(taken(i, "[^A-Z]", l))
        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(rest)), each), "")

    return _let(_shift_letters(key, letters, digits), lambda first: _let(permuted(first), lambda d: _let(_shift_letters(key, first, d), lambda l: filled(d, l))))


def _iban(key: str, m: Column) -> Column:
    known = F.try_element_at(F.create_map(*[F.lit(x) for c in IBAN_LENGTHS.split() for x in (c[:2], int(c[2:]))]), F.upper(F.substring(m, 1, 2)))
    # Of a longer candidate, in which words follow, the part that has the country's length.
    cut = F.call_function("regexp_extract", m, F.concat(F.lit("^((?: ?[A-Za-z0-9]){"), known.cast("string"), F.lit("})(?: .*)?$")), F.lit(1))
    head = F.when(known.isNotNull() & (F.length(cut) > 0), cut).otherwise(m)

    def made(part: Column) -> Column:
        s = F.upper(F.regexp_replace(part, " ", ""))
        country, rest = F.substring(s, 1, 2), F.substring(s, F.lit(5), F.length(s) - 4)
        capitals = part.rlike("^[A-Z]")
        valid = (F.length(s) >= 15) & F.when(known.isNotNull(), F.length(s) == known).otherwise(capitals) & (mod97(F.concat(rest, F.substring(s, 1, 4))) == 1)
        whole = _let(_account(key, rest), lambda r: F.concat(country, F.lpad((98 - mod97(F.concat(r, country, F.lit("00")))).cast("string"), 2, "0"), r))
        own = lambda w, i: F.substring(w, F.length(F.regexp_replace(F.substring(part, F.lit(1), i), " ", "")), F.lit(1))
        each = lambda w: F.array_join(F.transform(F.sequence(F.lit(1), F.length(part)), lambda i: F.when(F.substring(part, i, F.lit(1)) == " ", " ").otherwise(own(w, i))), "")
        laid = _let(whole, lambda w: F.when(capitals, each(w)).otherwise(F.lower(each(w))))
        return F.when(valid, F.concat(laid, F.substring(m, F.length(part) + 1, F.length(m))))

    return _let(head, made)


def _permuted_day(key: str, day: Column) -> Column:
    """A date of 1900-2099 permuted among those up to the 12th of a month, or among the later ones.

    Only later ones are readable with the month in front where the day could stand, so that a date's pseudonym is read in
    the layout that the date was, and is the same in each.
    """
    first, month = F.lit(FIRST_DAY).cast("date"), lambda d: (F.year(d) - 1900) * 12 + F.month(d) - 1
    whole = lambda v: F.lit(v).cast("long")
    early = feistel(key, "date 1-12", (month(day) * 12 + F.dayofmonth(day) - 1).cast("long"), *map(whole, EARLY))
    made = lambda v: F.make_date((F.floor(v / 144) + 1900).cast("int"), (F.floor(v / 12) % 12 + 1).cast("int"), (v % 12 + 1).cast("int"))

    def walk(v: Column) -> Column:  # the one value too many leads on
        return F.when(v == LATE[0] * LATE[1] - 1, feistel(key, "date 13-31", v, *map(whole, LATE))).otherwise(v)

    def counted(v: Column) -> Column:  # the v-th later day is 12 days further on for each month so far; its month is known to one or two
        near = F.floor(v * 2400 / (LATE[0] * LATE[1])).cast("int")
        days = F.transform(F.sequence(near - 2, near + 2), lambda k: F.struct(k.alias("k"), F.date_add(first, (v + 12 * (k + 1)).cast("int")).alias("d")))
        return F.filter(days, lambda x: (month(x["d"]) == x["k"]) & (F.dayofmonth(x["d"]) > 12))[0]["d"]

    late = feistel(key, "date 13-31", (F.datediff(day, first) - 12 * (month(day) + 1)).cast("long"), *map(whole, LATE))
    return F.when(F.dayofmonth(day) <= 12, _let(early, made)).otherwise(_let(_let(late, walk), counted))


def _date(key: str, m: Column) -> Column:
    sep = F.regexp_extract(m, "([-/.])", 1)
    plain = F.regexp_replace(m, "[/.]", "-")
    read = lambda layout: F.try_to_timestamp(plain, F.lit(layout)).cast("date")
    laid = lambda day, layout: F.regexp_replace(F.date_format(day, layout), F.lit("-"), sep)
    ymd, dmy, mdy = "yyyy-MM-dd", "dd-MM-yyyy", "MM-dd-yyyy"
    front = m.rlike("^[0-9]{4}")
    day = F.when(front, read(ymd)).otherwise(F.coalesce(read(dmy), read(mdy)))
    moved = lambda d: F.when(front, laid(d, ymd)).when(read(dmy).isNotNull(), laid(d, dmy)).otherwise(laid(d, mdy))
    return F.when(day.isNotNull(), _let(_let(day, lambda d: _permuted_day(key, d)), moved))


def _ssn(key: str, m: Column) -> Column:
    area, group, serial = F.substring(m, 1, 3).cast("long"), F.substring(m, 5, 2).cast("long"), F.substring(m, 8, 4).cast("long")
    x = (((area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1) * 9999 + serial - 1).cast("long")
    moved = feistel(key, "ssn", x, F.lit(898 * 99).cast("long"), F.lit(9999).cast("long"))

    def back(v: Column) -> Column:
        a = F.floor(v / (99 * 9999)) + 1
        return F.concat_ws("-", F.lpad((a + F.when(a >= 666, 1).otherwise(0)).cast("string"), 3, "0"), F.lpad((F.floor(v / 9999) % 99 + 1).cast("string"), 2, "0"), F.lpad((v % 9999 + 1).cast("string"), 4, "0"))

    return F.transform(F.array(moved), back)[0]


def _ipv4(key: str, m: Column) -> Column:
    part = [F.split_part(m, F.lit("."), F.lit(k)).cast("long") for k in (1, 2, 3, 4)]
    half = F.lit(65536).cast("long")
    moved = feistel(key, "ipv4", ((part[0] * 256 + part[1]) * 256 + part[2]) * 256 + part[3], half, half)
    return F.transform(F.array(moved), lambda v: F.concat_ws(".", *[F.shiftright(v, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]))[0]


def _phone(key: str, m: Column) -> Column:
    head = F.regexp_extract(m, rf"^(\+(?:{COUNTRY_CODES}))", 1)
    rest = F.substring(m, F.length(head) + 1, F.length(m))
    return F.when((F.length(_digits(m)) >= 7) & (F.length(_digits(rest)) <= 15), F.concat(head, _refill(rest, permute_digits(key, "phone", _digits(rest)))))


def pseudonym(key: str, m: Column) -> Column:
    """struct(kind, value) of a candidate; kind is null and the value unchanged where its validation fails."""
    secret = F.substring(keyed(key, "secret", m), F.lit(1), F.length(m))
    email = F.concat(F.lit("u"), F.substring(keyed(key, "email", F.lower(m)), 1, 16), F.lit("@pseudonym.invalid"))
    made = {"email": email, "secret": secret, "iban": _iban(key, m), "ipv4": _ipv4(key, m), "date": _date(key, m), "ssn": _ssn(key, m), "phone": _phone(key, m), "card": _card(key, m)}
    out = None
    for kind, value in made.items():
        # The first pattern that fits the whole candidate is the one that found it.
        fits = m.rlike(f"^(?:{PATTERNS[kind]})$")
        pair = F.struct(F.when(value.isNotNull(), F.lit(kind)).alias("kind"), F.coalesce(value, m).alias("value"))
        out = F.when(fits, pair) if out is None else out.when(fits, pair)
    return out.otherwise(F.struct(F.lit(None).cast("string").alias("kind"), m.alias("value")))


def mask(docs: DataFrame, key: str, text: str = "text", kinds: str = "_pii_kinds") -> DataFrame:
    """``docs`` with ``text`` masked and ``kinds``, the kinds of what was replaced, in order of place.

    A null text stays null and an empty one empty, both without kinds. Every row is masked alone: no shuffle, whatever
    the size of a text. Other columns pass through, whatever their names, but for one named as ``kinds``, which is replaced.
    Repeated rows are masked alike.
    """
    hit, gaps, made = fresh_names(docs, "hit", "gaps", "made")
    found = docs.withColumn(hit, F.coalesce(F.col(text).rlike("[0-9@]") & F.col(text).rlike(ANY), F.lit(False)))
    parts = F.when(F.col(hit), F.split(F.col(text), ANY, -1))
    put = F.when(F.col(hit), F.transform(F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0)), lambda m: pseudonym(key, m)))
    cut = found.withColumns({gaps: parts, made: put})
    joined = F.array_join(F.zip_with(gaps, F.transform(made, lambda v: v["value"]), lambda g, v: F.concat(g, F.coalesce(v, F.lit("")))), "")
    said = F.coalesce(F.filter(F.transform(made, lambda v: v["kind"]), lambda k: k.isNotNull()), F.array().cast("array<string>"))
    out = cut.withColumn(kinds, said).withColumn(text, F.when(F.col(hit), joined).otherwise(F.col(text)))
    return out.drop(hit, gaps, made)


#: The key of the registered query and pipeline where the session sets none, so that they run as trials. It protects nothing.
TRIAL_KEY = "trial key"


def secret_key(spark: SparkSession, trial: str | None = None) -> str:
    """The key of the pseudonyms: ``spark.quarterdeck.pii.key``. Without it the caller has to name a key for trials, and is warned."""
    key = spark.conf.get("spark.quarterdeck.pii.key", None)
    if key:
        return key
    if trial is None:
        raise ValueError("set spark.quarterdeck.pii.key: pseudonyms under a known key protect nothing")
    warnings.warn("spark.quarterdeck.pii.key is not set: these pseudonyms are for trials only", stacklevel=2)
    return trial


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced, and how many of each kind there were."""
    docs = mask(read_table(spark, sf_dir, "documents", "doc_id", "text"), secret_key(spark, TRIAL_KEY))
    n = lambda kind: F.size(F.filter("_pii_kinds", lambda k: k == kind)).cast("long").alias(f"n_{kind}")
    return docs.select("doc_id", "text", F.size("_pii_kinds").cast("long").alias("n_found"), F.sha2("text", 256).alias("text_sha256"), *[n(k) for k in PATTERNS])
