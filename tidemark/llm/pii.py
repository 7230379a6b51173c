"""Personal data under format-preserving Feistel pseudonyms (operator 8, native).

Card numbers (Luhn-valid), IPv4 addresses, phone numbers, social-security numbers,
calendar dates and e-mail names are found by pattern, validated, and replaced by a keyed
permutation of the same format: a balanced Feistel network over the two halves of the
value, its round function a keyed SHA-256. A permutation maps equal values to equal
pseudonyms, in every document, and different values to different ones. Cards keep a valid check digit,
dates stay dates (within their 73,000-day era), separators stay where they are. Matches that fail
validation stay as they are.

Digit groups with single blanks or hyphens, 13 digits or more, are read as one run: Luhn-valid cards
in it come first, in the groups that cards are written in or as the whole run; what is left of it,
or all of it if there is no card, is searched for phone numbers. Those have 8 to 15 digits after a
plus sign, in groups or not, or an area code (in brackets or not) and two groups, with any
character but a letter, digit or plus sign before them. National numbers without a separator or
in two groups without brackets can't be told from other numbers and stay.

DataFrame functions only: the text is split at the matches, the matches are mapped by
higher-order functions, and both are joined again. No shuffle.

Defined cases: null texts stay null; texts without matches stay untouched, byte for byte; a
name of more than 22 letters and digits keeps the permutation for the first 22 and
hashes the rest; a domain has at most 128 labels; upper and lower case of an e-mail name are one value; whole texts of any length
are read; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Labels before the last one are at most 126, as in a domain name: the matcher recurses once per label.
EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++){0,126}\.[A-Za-z]{2,}"
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])"
DATE = (r"(?<![0-9])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})"
        r"(?![0-9])")
SSN = r"(?<![0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])"
PLUS = (r"(?<![0-9+])\+(?:[0-9]{1,3}[ .\-]?(?:\([0-9]{2,4}\)[ .\-]?|[0-9]{2,4}[ .\-])[0-9]{3,4}[ .\-][0-9]{3,4}"
        r"|[0-9]{1,3}[ .\-][0-9]{2,5}[ .\-][0-9]{6,8}|[0-9](?:[ .\-]?[0-9]){7,14})(?![0-9])")
LOCAL = (r"(?:(?<![0-9+])\([0-9]{2,4}\)[ .\-]?|(?<![A-Za-z0-9+])[0-9]{2,4}[ .\-])"
         r"[0-9]{3,4}[ .\-][0-9]{3,4}(?![0-9])")
PHONE = "(?:%s)|(?:%s)" % (PLUS, LOCAL)
#: Digit groups, 13 digits at least, up to a date, address or social-security number; a letter before stays as context.
STOP = (r"(?!(?:[0-9]{1,3}\.){3}[0-9]|[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9])|[0-9]{2}[./][0-9]{2}[./][0-9]{4}(?![0-9])"
        r"|[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]))")
RUN = (r"[A-Za-z]?(?<![0-9])%s(?=[0-9](?:[ \-]?[0-9]){12})[0-9]++(?:(?: (?![A-Za-z0-9._%%+\-]*+@)|-)%s[0-9]++)*+"
       % (STOP, STOP))
#: How cards are grouped: these are found in longer runs as well (an expiry or check number may follow).
CARD = (r"^(?:[0-9]{13,19}|[0-9]{4}(?:[ \-][0-9]{4}){2}[ \-][0-9]{1,4}|[0-9]{4}(?:[ \-][0-9]{4}){3}[ \-][0-9]{1,3}"
        r"|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{4,5}|[0-9]{8}[ \-][0-9]{8}|[0-9]{6}[ \-][0-9]{13})$")
ANY = "|".join("(?:%s)" % p for p in (EMAIL, IPV4, DATE, SSN, PLUS, RUN, LOCAL))
ROUNDS, ERA = 8, 73_000


def _draw(key: Column, tweak, i, x, below) -> Column:
    """The round function: keyed, below ``below``."""
    h = F.sha2(F.concat_ws("|", key, tweak, i.cast("string"), x.cast("string")).cast("binary"), 256)
    return F.pmod(F.conv(F.substring(h, 1, 15), 16, 10).cast("long"), below)


def feistel(a, b, below_a, below_b, key: Column, tweak) -> Column:
    """struct(a, b): the pair permuted within [0, below_a) x [0, below_b)."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def step(s, i):
        even = i % 2 == 0
        return F.struct(
            F.when(even, F.pmod(s["a"] + _draw(key, tweak, i, s["b"], below_a), below_a)).otherwise(s["a"]).alias("a"),
            F.when(even, s["b"]).otherwise(F.pmod(s["b"] + _draw(key, tweak, i, s["a"], below_b), below_b)).alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _power(radix: int, n) -> Column:
    return F.round(F.pow(F.lit(float(radix)), n.cast("double"))).cast("long")


def _via(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` worked out once, however often ``fn`` uses it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def permute_string(s: Column, radix: int, key: Column, tweak: str) -> Column:
    """A string of digits of ``radix`` (10 or 36, up to 30 or 22 digits) permuted among
    the strings of its length."""
    def whole(s):
        n = F.length(s)
        u = F.floor(n / 2).cast("int")
        v = n - u
        half = lambda x: F.coalesce(F.conv(x, radix, 10).cast("long"), F.lit(0))
        pair = feistel(half(F.substring(s, F.lit(1), u)), half(F.substring(s, u + 1, v)), _power(radix, u),
                       _power(radix, v), key, F.concat(F.lit(tweak + "|"), n.cast("string")))
        show = lambda x, k: F.when(k > 0, F.lpad(F.lower(F.conv(x.cast("string"), 10, radix)), k, F.lit("0")))
        return _via(pair, lambda p: F.concat(F.coalesce(show(p["a"], u), F.lit("")), show(p["b"], v)))
    return F.when(F.length(s) > 0, _via(s, whole)).otherwise(s)


def refill(template: Column, symbol: str, new: Column) -> Column:
    """``template`` with its characters of class ``symbol`` replaced, in order, by ``new``."""
    def at(i):
        c = F.substring(template, i, F.lit(1))
        nth = F.length(F.regexp_replace(F.substring(template, F.lit(1), i), "[^%s]" % symbol, ""))
        return F.when(c.rlike("[%s]" % symbol), F.substring(new, nth, F.lit(1))).otherwise(c)
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(template)), at), "")


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn_sum(d: Column) -> Column:
    """The Luhn sum of a digit string: a valid number's is a multiple of 10."""
    def add(acc, i):
        v = F.substring(d, F.length(d) + 1 - i, F.lit(1)).cast("int")
        w = F.when(i % 2 == 0, v * 2).otherwise(v)
        return acc + F.when(w > 9, w - 9).otherwise(w)
    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add)


def _card(m: Column, key: Column) -> Column:
    def new(d):
        body = permute_string(F.substring(d, F.lit(1), F.length(d) - 1), 10, key, "card")
        return _via(body, lambda b: F.concat(b, F.pmod(10 - luhn_sum(F.concat(b, F.lit("0"))) % 10, F.lit(10))
                                             .cast("string")))
    return F.when(luhn_sum(_digits(m)) % 10 == 0, refill(m, "0-9", _via(_digits(m), new)))


def _phone(m: Column, key: Column) -> Column:
    """The last ten digits (all but the first, if fewer) are permuted; a leading code stays."""
    def new(d):
        k = F.least(F.lit(10), F.length(d) - 1)
        return F.concat(F.substring(d, F.lit(1), F.length(d) - k),
                        permute_string(F.substring(d, F.length(d) - k + 1, k), 10, key, "phone"))
    return F.when(F.length(_digits(m)).between(7, 15), refill(m, "0-9", _via(_digits(m), new)))


def _ssn(m: Column, key: Column) -> Column:
    sound = ~m.rlike("^(?:000|666|9)") & ~m.rlike("-00-|-0000$")
    return F.when(sound, refill(m, "0-9", permute_string(_digits(m), 10, key, "ssn")))


def _ipv4(m: Column, key: Column) -> Column:
    def new(o):
        pair = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), key, F.lit("ipv4"))
        part = lambda x: F.concat(F.floor(x / 256).cast("string"), F.lit("."), (x % 256).cast("string"))
        return F.when(F.forall(o, lambda v: v <= 255),
                      _via(pair, lambda p: F.concat(part(p["a"]), F.lit("."), part(p["b"]))))
    return _via(F.transform(F.split(m, "\\."), lambda v: v.cast("int")), new)


def _date(m: Column, key: Column) -> Column:
    """Day numbers permuted within eras of 73,000 = 250 x 292 days; month-first for slashes."""
    def shift(fmt):
        def new(day):
            era = F.floor(day / ERA)
            rest = day - era * ERA
            pair = feistel(F.floor(rest / 292), rest % 292, F.lit(250), F.lit(292), key, F.concat(
                F.lit("date|"), era.cast("string")))
            return _via(pair, lambda p: F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), (
                era * ERA + p["a"] * 292 + p["b"]).cast("int")), fmt))
        day = F.datediff(F.try_to_timestamp(m, F.lit(fmt)).cast("date"), F.lit("1900-01-01").cast("date"))
        in_era = (day >= 0) & (day < ERA)                       # outside: another era would leave four-digit years
        return F.when(in_era, _via(day, new))
    return (F.when(m.contains("-"), shift("yyyy-MM-dd")).when(m.contains("."), shift("dd.MM.yyyy"))
            .otherwise(shift("MM/dd/yyyy")))


def _email(m: Column, key: Column) -> Column:
    def new(name):
        core = F.lower(F.regexp_replace(name, "[^A-Za-z0-9]", ""))
        fresh = F.concat(permute_string(F.substring(core, F.lit(1), F.lit(22)), 36, key, "email"),
                         F.when(F.length(core) > 22, F.repeat(F.sha2(F.concat(key, core).cast("binary"), 256), 16))
                         .otherwise(F.lit("")))
        return _via(fresh, lambda f: refill(name, "A-Za-z0-9", f))
    return F.concat(_via(F.substring_index(m, "@", 1), new), F.lit("@"), F.substring_index(m, "@", -1))


def _cards(tokens: Column) -> Column:
    """Where Luhn-valid cards in a card's usual groups stand among a run's groups: array of (at, size)."""
    def found(i):
        def sound(k):
            card = lambda w: w.rlike(CARD) & (luhn_sum(_digits(w)) % 10 == 0)
            text = F.regexp_replace(F.array_join(F.slice(tokens, i + 1, F.lit(k)), ""), "^[^0-9]", "")
            return (i + k <= F.size(tokens)) & _via(text, card)
        size = F.lit(None).cast("int")
        for k in (2, 5, 3, 1, 4):                               # sixteen digits in fours come first
            size = F.when(sound(k), F.lit(k)).otherwise(size)
        return F.struct(i.alias("at"), size.alias("size"))

    def apart(acc, x):
        last = F.get(acc, F.size(acc) - 1)
        return F.when(F.coalesce(last["at"] + last["size"], F.lit(0)) <= x["at"], F.concat(acc, F.array(x))).otherwise(acc)
    sound = F.filter(F.transform(F.sequence(F.lit(0), F.size(tokens) - 1), found), lambda x: x["size"].isNotNull())
    return F.aggregate(sound, F.array().cast("array<struct<at:int,size:int>>"), apart)


def _phones(s: Column, key: Column) -> Column:
    """struct(kinds, value): the phone numbers in ``s`` replaced."""
    made = F.transform(F.regexp_extract_all(s, F.lit(PHONE), F.lit(0)), lambda m: F.struct(
        m.alias("old"), _phone(m, key).alias("new")))
    join = lambda p, r: F.concat(p, F.coalesce(r["new"], r["old"], F.lit("")))
    return _via(made, lambda a: F.struct(
        F.transform(F.filter(a, lambda r: r["new"].isNotNull()), lambda r: F.lit("phone")).alias("kinds"),
        F.array_join(F.zip_with(F.split(s, PHONE, -1), a, join), "").alias("value")))


def _numbers(m: Column, key: Column) -> Column:
    """struct(kinds, value): the cards of a run of digit groups, and the phone numbers in what is
    left. A whole run that is Luhn-valid is a card in any grouping, unless it mixes blanks and
    hyphens and a phone number is found in it (a phone number and a number after it)."""
    d = _digits(m)
    run = m.rlike("^[A-Za-z]?[0-9]") & (F.length(d) >= 13)
    whole = ((F.length(d) <= 19) & (luhn_sum(d) % 10 == 0)
             & (~(m.contains(" ") & m.contains("-")) | ~m.rlike(PHONE)))

    def cut(tokens):
        text = lambda lo, n: F.array_join(F.slice(tokens, lo + 1, n), "")

        def pieces(cards):
            def piece(j):
                lo = F.when(j == 0, F.lit(0)).otherwise(F.get(cards, j - 1)["at"] + F.get(cards, j - 1)["size"])
                at, size = F.get(cards, j)["at"], F.get(cards, j)["size"]
                before = F.regexp_extract(F.coalesce(F.get(tokens, at), F.lit("")), "^[^0-9]?", 0)
                left = text(lo, F.coalesce(at, F.size(tokens)) - lo)
                return F.array(F.struct(F.lit(False).alias("card"), F.concat(left, before).alias("s")),
                               F.struct(F.lit(True).alias("card"), F.coalesce(F.regexp_replace(
                                   text(at, size), "^[^0-9]", ""), F.lit("")).alias("s")))
            return F.flatten(F.transform(F.sequence(F.lit(0), F.size(cards)), piece))
        usual = lambda c: F.when((F.size(c) == 0) & whole, F.array(F.struct(
            F.lit(0).alias("at"), F.size(tokens).alias("size")))).otherwise(c)
        return _via(_via(_cards(tokens), usual), pieces)

    plain = F.array(F.struct(F.lit(False).alias("card"), m.alias("s")))
    parts = F.when(run, _via(F.regexp_extract_all(m, F.lit("[^0-9]?[0-9]+"), F.lit(0)), cut)).otherwise(plain)
    made = F.transform(F.filter(parts, lambda p: p["s"] != ""), lambda p: F.when(p["card"], F.struct(
        F.array(F.lit("card")).alias("kinds"), _card(p["s"], key).alias("value"))).otherwise(_phones(p["s"], key)))
    return _via(made, lambda a: F.struct(F.flatten(F.transform(a, lambda r: r["kinds"])).alias("kinds"),
                                         F.array_join(F.transform(a, lambda r: r["value"]), "").alias("value")))


def _replace(m: Column, key: Column) -> Column:
    """struct(kinds, value): the pseudonym of a match; no kinds and the match itself if it fails validation."""
    def one(kind, value):
        none = F.array().cast("array<string>")
        return _via(value, lambda v: F.struct(F.when(v.isNotNull(), F.array(F.lit(kind))).otherwise(none).alias("kinds"),
                                              F.coalesce(v, m).alias("value")))
    made = _numbers(m, key)
    for kind, pattern, fn in (("ssn", SSN, _ssn), ("date", DATE, _date), ("ipv4", IPV4, _ipv4), ("email", EMAIL, _email)):
        made = F.when(m.rlike("^(?:%s)$" % pattern), one(kind, fn(m, key))).otherwise(made)
    return made


def pseudonymise(docs: DataFrame, key: str = "change-me", text_col: str = "text", into: str = "private") -> DataFrame:
    """``docs`` with a struct column ``into``: text (pseudonymised) and found (an array of the
    kinds replaced, in order of appearance)."""
    t, k = F.col(text_col), F.lit(key)
    made = F.transform(F.regexp_extract_all(t, F.lit(ANY), F.lit(0)), lambda m: _replace(m, k))
    parts = F.split(t, ANY, -1)
    join = lambda p, r: F.concat(p, F.coalesce(r["value"], F.lit("")))
    none = F.array().cast("array<string>")
    out = F.when(t.rlike("[0-9@]"), _via(made, lambda m: F.struct(
        F.when(F.size(m) > 0, F.array_join(F.zip_with(parts, m, join), "")).otherwise(t).alias("text"),
        F.flatten(F.transform(m, lambda r: r["kinds"])).alias("found"))))
    return docs.withColumn(into, F.coalesce(out, F.struct(t.alias("text"), none.alias("found"))))
