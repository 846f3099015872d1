"""Operator 1: format-preserving pseudonyms by keyed Feistel networks (DataFrame functions only).

Emails, secrets after a name (password=..., token: ..., Bearer ...), vendor tokens, private-key
blocks, access keys, IBANs, card and other long numbers, social security numbers, phone numbers
(national ones with signs between their digits, too), IPv4 and IPv6 addresses and dates are
found by one regular expression, validated, and permuted within their format under a key:

* letters and digits move within their own class (digit, a-z, A-Z) through an eight-round
  Feistel network over the two halves of the value; signs between them stay in place;
* a card number with a valid Luhn digit keeps its first digit and gets the right check digit;
  another long number is walked through its network until its Luhn digit is wrong again and
  it reads as no date or card, so the two kinds never share a pseudonym;
* an IPv4 address is a network on its two 16-bit halves, so every result is a valid address;
  one written with leading zeros keeps the widths of its octets and a leading zero;
* the hexadecimal digits of an IPv6 address move among digits, a-f and A-F, its colons stay;
* a valid date of 1900-2099 is a network on its day number, walked until it is back in
  1900-2099, so every result is a real date that is found again;
* a secret is the whole value up to its closing quote or white space; without quotes after a
  colon it needs a digit, a sign inside or a capital after a small letter (``token: words`` is
  prose), and at least four characters;
* an IBAN keeps its country and gets the right check digits.

Equal values get equal pseudonyms in every document whatever signs stand between their
digits, different values different ones, and ``inverse=True`` with the key undoes it.

Edge cases: a null text stays null with 0 replacements; an empty text stays empty; text
outside the values is untouched; invalid dates and addresses are left alone; repeated rows
get the same result; other columns are kept (`n_pii` replaces a clashing one); an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
WALK = 64  # steps of a cycle walk; each goes on for about one value in ten
DAYS = (271, 270)  # days from 1900-01-01 on, as the product of two halves
LAST_DAY = 73_048  # 2099-12-31
DEFAULT_KEY = "change-this-key"

# Letters beyond A-Z stay in place, the other characters of such an address are permuted.
EMAIL = r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]{1,64}@(?:[\p{L}0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\p{L}0-9-])"
ACCESS_KEY = r"(?<![A-Za-z0-9])A[KS]IA[0-9A-Z]{16}(?![A-Za-z0-9])"
SECRET_NAME = (
    r"(?<![A-Za-z])(?:[Pp]assword|PASSWORD|[Pp]asswort|PASSWORT|[Pp]asswd|[Pp]ass|PASS|[Pp]wd|[Ss]ecret|SECRET|[Tt]oken|TOKEN|[Aa]pi[_-]?[Kk]ey|API[_-]?KEY)"
    r"(?:_[A-Za-z]{1,16}){0,3}[\"']?\s{0,8}[=:]\s{0,8}[\"']?"
)
# After the name: the rest of a quoted value, a value after =, a value after : that does not look like a word.
SECRET_VALUE = (
    r"(?:(?<=\")[^\"\n](?:[^\n]*?[^\\\n])??(?=\")|(?<=')[^'\n](?:[^\n]*?[^\\\n])??(?='(?![A-Za-z0-9]))"
    r"|(?<=[=\"']|=\s{1,8})[^\s\"']{4,}|(?=[^\s\"']*[0-9]|[^\s\"']*[@#$%^&*+=~!?_][A-Za-z]|[^\s\"']*[a-z][A-Z])[^\s\"']{4,})"
)
SECRET = SECRET_NAME + SECRET_VALUE
# What stands before a token without = or :, and is kept.
TOKEN_NAME = r"(?<![A-Za-z0-9_-])(?:(?:[Bb]earer|BEARER)\s{1,4}|gh[opsru]_|github_pat_|glpat-|sk-|xox[abprs]-|AIza)"
TOKEN = TOKEN_NAME + r"(?=[^\s0-9]*[0-9])[A-Za-z0-9._~+/=-]{16,}"
KEY_NAME = r"-----BEGIN (?:[A-Z]{1,12} ){0,3}PRIVATE KEY-----"
KEY_BLOCK = KEY_NAME + r"[A-Za-z0-9+/=\s]{16,}(?=-----END )"
# Countries by the length of their IBAN.
IBAN_LENGTH = {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN = (
    r"(?<![0-9A-Za-z])(?:"
    + "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:[ -]?[0-9A-Z]){{{n - 4}}}" for n, c in IBAN_LENGTH.items())
    + r")(?![0-9A-Za-z])"
)
DATE = r"(?<![0-9./-])(?:(?:19|20)[0-9]{2}([-/.])(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12][0-9]|3[01])|(?:0[1-9]|[12][0-9]|3[01])([-/.])(?:0[1-9]|[12][0-9]|3[01])\2(?:19|20)[0-9]{2})(?![0-9]|[./-][0-9])"
# Eight groups, or fewer around one ::, at least three of them and a digit among them.
IPV6 = (
    r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]*[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?=[0-9A-Fa-f]{1,4}:[0-9A-Fa-f:]*:[0-9A-Fa-f]+)(?!(?:[0-9A-Fa-f]*:){8})(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:]|\.[0-9])"
)
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
PHONE = r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])"
# National numbers: a trunk 0 and 9 to 12 digits in groups, or nine digits in groups as in Spain.
NATIONAL = (
    r"(?<![0-9A-Za-z./-])(?:(?=(?:[0-9][ ./-]?){9,12}(?![0-9]|[ ./-][0-9]))0[1-9][0-9]{0,4}(?:[ ./-][0-9]{2,8}){1,5}"
    r"|[6-9][0-9]{2} [0-9]{3} [0-9]{3}|[6-9][0-9]{2}(?: [0-9]{2}){3}|[89][0-9] [0-9]{3} [0-9]{2} [0-9]{2})(?![0-9A-Za-z]|[ ./-][0-9])"
)
NUMBER = r"(?<![0-9A-Za-z.])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z]|\.[0-9])"
ANY = "|".join((KEY_BLOCK, EMAIL, ACCESS_KEY, TOKEN, SECRET, IBAN, DATE, IPV6, IPV4, SSN, PHONE, NATIONAL, NUMBER))
PLAIN = "[^0-9A-Za-z]"
PADDED = r"(?:^|[.])0[0-9]"


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _rounds(inverse: bool) -> Column:
    steps = range(ROUNDS, 0, -1) if inverse else range(1, ROUNDS + 1)
    return F.array(*(F.lit(r) for r in steps))


def _digest(key: str, kind: str, r: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), other), 512)


def _shift(text: Column, digest: Column, sign: int, letters: int = 26) -> Column:
    """Every letter (of the first ``letters``) or digit moved within its class by the digest's byte at its place."""

    def move(c: Column, i: Column) -> Column:
        code = F.ascii(c)
        by = sign * F.conv(F.substring(digest, 2 * F.pmod(i, F.lit(64)) + 1, F.lit(2)), 16, 10).cast("int")

        def within(low: int, size: int) -> Column:
            return F.chr((F.pmod(code - low + by, F.lit(size)) + low).cast("long"))

        return F.when(code < 58, within(48, 10)).when(code < 91, within(65, letters)).otherwise(within(97, letters))

    return F.when(F.length(text) > 0, F.array_join(F.transform(F.split(text, ""), move), "")).otherwise(text)


def permute_text(core: Column, key: str, kind: str, inverse: bool = False, letters: int = 26) -> Column:
    """Feistel network over the halves of a string of letters and digits."""
    half = F.ceil(F.length(core) / 2).cast("int")
    sign = -1 if inverse else 1
    start = F.struct(F.substring(core, F.lit(1), half).alias("l"), F.substring(core, half + 1, F.length(core)).alias("r"))

    def step(s: Column, r: Column) -> Column:
        odd = r % 2 == 1
        other = F.concat_ws("/", F.length(core).cast("string"), F.when(odd, s["r"]).otherwise(s["l"]))
        return _let(
            _digest(key, kind, r, other),
            lambda d: F.struct(
                F.when(odd, _shift(s["l"], d, sign, letters)).otherwise(s["l"]).alias("l"),
                F.when(odd, s["r"]).otherwise(_shift(s["r"], d, sign, letters)).alias("r"),
            ),
        )

    return F.aggregate(_rounds(inverse), start, step, lambda s: F.concat(s["l"], s["r"]))


def permute_pair(a: Column, b: Column, sizes: tuple, key: str, kind: str, inverse: bool = False) -> Column:
    """Feistel network on a pair of numbers below ``sizes``; a struct (a, b)."""
    sign = -1 if inverse else 1
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def step(s: Column, r: Column) -> Column:
        odd = r % 2 == 1
        d = _digest(key, kind, r, F.when(odd, s["b"]).otherwise(s["a"]).cast("string"))
        by = sign * F.conv(F.substring(d, 1, 12), 16, 10).cast("long")
        return F.struct(
            F.when(odd, F.pmod(s["a"] + by, F.lit(sizes[0]))).otherwise(s["a"]).alias("a"),
            F.when(odd, s["b"]).otherwise(F.pmod(s["b"] + by, F.lit(sizes[1]))).alias("b"),
        )

    return F.aggregate(_rounds(inverse), start, step)


def _fill(shape: Column, core: Column) -> Column:
    """``shape`` with its letters and digits replaced, in order, by those of ``core``."""
    return F.array_join(
        F.zip_with(F.split(shape, "[0-9A-Za-z]"), F.split(core, ""), lambda sign, c: F.concat(F.coalesce(sign, F.lit("")), F.coalesce(c, F.lit("")))), ""
    )


def _luhn_sum(digits: Column, double_last: bool) -> Column:
    """Luhn sum of a digit string; the last digit is doubled or not."""
    n = F.length(digits)

    def one(acc: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = (n - i) % 2 == (0 if double_last else 1)
        return acc + F.when(twice, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), one)


def _card(digits: Column, key: str, inverse: bool) -> Column:
    """First digit kept, the others permuted, the check digit made right."""
    inner = F.substring(digits, F.lit(2), F.length(digits) - 2)
    body = F.concat(F.substring(digits, 1, 1), permute_text(inner, key, "card", inverse))
    return _let(body, lambda b: F.concat(b, ((10 - _luhn_sum(b, True) % 10) % 10).cast("string")))


def _number(value: Column, key: str, inverse: bool) -> Column:
    def network(digits: Column) -> Column:
        return permute_text(digits, key, "number", inverse)

    def other_kind(digits: Column) -> Column:
        # A card, or (where the signs stand as in a date) a text that begins with a date.
        return (_luhn_sum(digits, False) % 10 == 0) | _fill(value, digits).rlike("^(?:" + DATE + ")")

    def walked(first: Column) -> Column:
        # A step stays among the other kinds for about one value in ten; each cycle leads back to the start.
        steps = F.when(other_kind(first), F.sequence(F.lit(1), F.lit(WALK))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, first, lambda d, _: F.when(other_kind(d), network(d)).otherwise(d))

    def permuted(digits: Column) -> Column:
        plain = _let(network(digits), walked)
        return _fill(value, F.when(_luhn_sum(digits, False) % 10 == 0, _card(digits, key, inverse)).otherwise(plain))

    return _let(F.regexp_replace(value, "[^0-9]", ""), permuted)


def _ipv4(value: Column, key: str, inverse: bool) -> Column:
    """Addresses without leading zeros among themselves, others among those of their octets' widths."""

    def octets(o: Column) -> list[Column]:
        return [F.get(o, k).cast("int") for k in range(4)]

    def halves(p: Column) -> list[Column]:
        return [F.floor(p["a"] / p["s1"]), p["a"] % p["s1"], F.floor(p["b"] / p["s3"]), p["b"] % p["s3"]]

    def permuted(o: Column) -> Column:
        part = octets(o)
        pair = permute_pair(part[0] * 256 + part[1], part[2] * 256 + part[3], (65536, 65536), key, "ipv4", inverse)
        text = _let(pair, lambda p: F.concat_ws(".", *(F.floor(x / 256).cast("string") if hi else (x % 256).cast("string") for x in (p["a"], p["b"]) for hi in (True, False))))
        return F.when(F.greatest(*part) < 256, F.when(value.rlike(PADDED), padded(o)).otherwise(text)).otherwise(value)

    def padded(o: Column) -> Column:
        width = [F.length(F.get(o, k)) for k in range(4)]
        size = [F.when(w == 1, 10).when(w == 2, 100).otherwise(256).cast("long") for w in width]
        part = octets(o)

        def written(p: Column) -> Column:
            return F.concat_ws(".", *(F.lpad(x.cast("string"), w, "0") for x, w in zip(halves(p), width)))

        def network(p: Column) -> Column:
            moved = permute_pair(p["a"], p["b"], (size[0] * size[1], size[2] * size[3]), key, "padded", inverse)
            return _let(moved, lambda m: F.struct(m["a"].alias("a"), m["b"].alias("b"), size[1].alias("s1"), size[3].alias("s3")))

        def walked(first: Column) -> Column:
            # At least one image in ten has a leading zero again.
            steps = F.when(~written(first).rlike(PADDED), F.sequence(F.lit(1), F.lit(8 * WALK))).otherwise(F.array().cast("array<int>"))
            return F.aggregate(steps, first, lambda p, _: F.when(~written(p).rlike(PADDED), network(p)).otherwise(p), written)

        start = F.struct((part[0] * size[1] + part[1]).alias("a"), (part[2] * size[3] + part[3]).alias("b"), size[1].alias("s1"), size[3].alias("s3"))
        return _let(network(start), walked)

    return _let(F.split(value, "[.]"), permuted)


def _date(value: Column, key: str, inverse: bool) -> Column:
    """Year-first, day-first or (only if no valid day-first) month-first dates."""
    year_first = value.rlike("^[0-9]{4}")
    sep = F.when(year_first, F.substring(value, 5, 1)).otherwise(F.substring(value, 3, 1))
    first, second = F.substring(value, 1, 2), F.substring(value, 4, 2)
    ymd = F.concat_ws("-", F.substring(value, 1, 4), F.substring(value, 6, 2), F.substring(value, 9, 2)).try_cast("date")
    dmy = F.concat_ws("-", F.substring(value, 7, 4), second, first).try_cast("date")
    mdy = F.concat_ws("-", F.substring(value, 7, 4), first, second).try_cast("date")
    day = F.when(year_first, ymd).otherwise(F.coalesce(dmy, mdy))
    base = F.lit("1900-01-01").cast("date")

    def permuted(number: Column) -> Column:
        def back(p: Column) -> Column:
            when = F.date_add(base, (p["a"] * DAYS[1] + p["b"]).cast("int"))
            y, m, d = (F.date_format(when, x) for x in ("yyyy", "MM", "dd"))
            # A month-first value stays month-first only while its day shows that it is.
            return F.when(year_first, F.concat_ws("-", y, m, d)).otherwise(F.concat_ws("-", d, m, y))

        def network(p: Column) -> Column:
            return permute_pair(p["a"], p["b"], DAYS, key, "date", inverse)

        def outside(p: Column) -> Column:
            return p["a"] * DAYS[1] + p["b"] > LAST_DAY

        def walked(p: Column) -> Column:
            # Fewer than DAYS[0] * DAYS[1] - LAST_DAY steps lead back: no day is passed twice.
            steps = F.when(outside(p), F.sequence(F.lit(1), F.lit(DAYS[0] * DAYS[1] - LAST_DAY))).otherwise(F.array().cast("array<int>"))
            return F.aggregate(steps, p, lambda s, _: F.when(outside(s), network(s)).otherwise(s))

        start = F.struct(F.floor(number / DAYS[1]).cast("long").alias("a"), (number % DAYS[1]).cast("long").alias("b"))
        return F.coalesce(F.translate(_let(_let(network(start), walked), back), "-", "\x01"), value)

    moved = _let(F.date_diff(day, base), permuted)
    return F.when(day.isNotNull(), F.replace(moved, F.lit("\x01"), sep)).otherwise(value)


def _iban_check(country: Column, inner: Column) -> Column:
    """The right check digits as a number of 2 to 98."""

    def add(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, (acc * 10 + code - 48) % 97).otherwise((acc * 100 + code - 55) % 97)

    return F.lit(98) - F.aggregate(F.split(F.concat(inner, country, F.lit("00")), ""), F.lit(0), add)


def _iban(value: Column, key: str, inverse: bool) -> Column:
    """Country kept, the rest permuted, the check digits made right.

    A value that fails the check is no IBAN: in one piece it is left alone, in groups (it holds
    a long number) its rest is permuted and its check stays as wrong as it was.
    """

    def permuted(core: Column) -> Column:
        country, given, inner = F.substring(core, 1, 2), F.substring(core, 3, 2).cast("int"), F.substring(core, F.lit(5), F.length(core))

        def checked(new: Column) -> Column:
            off = given - _iban_check(country, inner)
            check = F.when(given.between(2, 98), F.pmod(_iban_check(country, new) - 2 + off, F.lit(97)) + 2).otherwise(given)
            moved = _fill(value, F.concat(country, F.lpad(check.cast("string"), 2, "0"), new))
            return F.when((off != 0) & (F.length(value) == F.length(core)), value).otherwise(moved)

        return _let(permute_text(inner, key, "iban", inverse), checked)

    return _let(F.regexp_replace(value, PLAIN, ""), permuted)


def pseudonym(value: Column, key: str, inverse: bool = False) -> Column:
    """Replacement of one found value, by its kind."""

    def plain(text: Column, kind: str) -> Column:
        return _fill(text, permute_text(F.regexp_replace(text, PLAIN, ""), key, kind, inverse))

    last = F.regexp_extract(value, r"(\.[A-Za-z]+)$", 1)
    email = F.concat(plain(F.substring(value, F.lit(1), F.length(value) - F.length(last)), "email"), last)
    name = F.regexp_extract(value, "^(" + SECRET_NAME + ")", 1)
    secret = F.concat(name, plain(F.substring(value, F.length(name) + 1, F.length(value)), "secret"))
    token = F.regexp_extract(value, "^(" + TOKEN_NAME + "|" + KEY_NAME + ")", 1)
    bare = F.concat(token, plain(F.substring(value, F.length(token) + 1, F.length(value)), "secret"))
    ipv6 = _fill(value, permute_text(F.regexp_replace(value, PLAIN, ""), key, "ipv6", inverse, 6))
    access = F.concat(F.substring(value, 1, 4), plain(F.substring(value, F.lit(5), F.length(value)), "access"))
    country = F.regexp_extract(value, r"^(\+[0-9]{1,3}(?=[ .(-]))", 1)
    phone = F.concat(country, plain(F.substring(value, F.length(country) + 1, F.length(value)), "phone"))
    kept = F.when(value.startswith("0"), 2).otherwise(1)  # what makes it a national number stays
    national = F.concat(F.substring(value, F.lit(1), kept), plain(F.substring(value, kept + 1, F.length(value)), "phone"))
    return (
        F.when(value.rlike("^(?:" + KEY_BLOCK.split("(?=")[0] + "|" + TOKEN + ")$"), bare)
        .when(value.rlike("^" + SECRET_NAME), secret)
        .when(value.contains("@"), email)
        .when(value.rlike("^" + ACCESS_KEY + "$"), access)
        .when(value.rlike("^" + IBAN + "$"), _iban(value, key, inverse))
        .when(value.rlike("^(?:" + DATE + ")$"), _date(value, key, inverse))
        .when(value.rlike("^" + IPV6 + "$"), ipv6)
        .when(value.rlike("^" + IPV4 + "$"), _ipv4(value, key, inverse))
        .when(value.rlike("^" + SSN + "$"), plain(value, "ssn"))
        .when(value.rlike("^" + PHONE + "$"), phone)
        .when(value.rlike("^" + NATIONAL + "$"), national)
        .otherwise(_number(value, key, inverse))
    )


def pseudonymise(docs: DataFrame, key: str = DEFAULT_KEY, text_col: str = "text", inverse: bool = False) -> DataFrame:
    """All rows and columns; the text with pseudonyms, and `n_pii`, the values replaced."""
    text = F.col(text_col)
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))

    def rebuilt(values: Column) -> Column:
        between = F.split(text, ANY)
        new = F.transform(values, lambda v: pseudonym(v, key, inverse))
        joined = F.array_join(F.zip_with(between, new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
        return F.struct(F.when(F.size(values) > 0, joined).otherwise(text).alias("text"), F.size(values).alias("n"))

    untouched = F.struct(text.alias("text"), F.lit(0).alias("n"))
    result = F.when(text.rlike("[0-9@=:]"), _let(found, rebuilt)).otherwise(untouched)
    out = docs.drop("n_pii").withColumn("_pii", F.explode(F.array(result)))
    return out.withColumn(text_col, F.col("_pii.text")).withColumn("n_pii", F.col("_pii.n").cast("long")).drop("_pii")
