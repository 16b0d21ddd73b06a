"""Format-preserving Feistel pseudonyms of personal data, in Spark expressions only.

Found values are checked (Luhn digit, octets, calendar, area codes), then permuted inside their own format by Feistel
networks keyed with a secret:

* card numbers: the digits between the first and the check digit, with a new Luhn digit; separators stay;
* telephone numbers: subscriber and area digits, within the numbering plan where the number follows it; the country code
  and the punctuation stay;
* bank account numbers (IBAN): letters and digits after the check digits, each within its own alphabet, with new check
  digits; the country stays;
* IPv4 addresses: the four octets; social security numbers: valid areas, groups and serials;
* dates from 1900 to 2099: year, month and day within the dates that the same layout can show, padding included; slash dates
  are month first, or day first where the month would be over 12, and stay so;
* e-mail addresses: letters and digits of the part before the @, each within its own alphabet; credentials (key ids,
  tokens, passwords): likewise.

A permutation has no collisions: equal values have equal pseudonyms in every document, different values different ones.
What fails its check is no personal data and stays, as does all other text.

Defined results: a null text stays null, an empty one empty; a text without findings is returned unchanged; any length is
read whole; values that overlap are taken from the left; repeated rows are kept; an empty table gives an empty result;
other columns pass through untouched, whatever their names. The findings stand in the column ``pii``, or ``pii_``, ``pii__``
and so on where that name is taken (``findings`` tells which). There is no default key: whoever has it can undo nothing, but
can test guesses, so a caller brings its own secret.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The key of the registered query and pipeline, if the session has no ``spark.deidflow.pii.key``; it is public, so it hides nothing.
DEMO_KEY = "deidflow-demo-key"
KEY_SETTING = "spark.deidflow.pii.key"
ROUNDS = 8
#: Rounds of cuts at most; each takes a group or more off every such hit, and a hit has 19 groups at most.
CUTS = 40
FIRST_YEAR, YEARS = 1900, 200

EMAIL = r"[A-Za-z0-9._%+\-]++@[A-Za-z0-9](?:[A-Za-z0-9.\-]*[A-Za-z0-9])?\.[A-Za-z]{2,}"
AWS = r"(?<![A-Za-z0-9])A[KS]IA[0-9A-Z]{16}(?![A-Za-z0-9])"
SECRET = r"(?<![A-Za-z])(?i:password|passwd|pwd|secret|token|api[_\-]?key|access[_\-]?key)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9+/_\-]{8,}+"
DATE = r"(?<![0-9A-Za-z./\-])(?:(?:19|20)[0-9]{2}-[01][0-9]-[0-3][0-9]|[0-9]{1,2}/[0-9]{1,2}/(?:19|20)[0-9]{2}|[0-9]{1,2}\.[0-9]{1,2}\.(?:19|20)[0-9]{2})(?![0-9])"
SSN = r"(?<![0-9A-Za-z\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z\-])"
IPV4 = r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
CARD = r"(?<![0-9A-Za-z.\-])[0-9](?:[ \-]?[0-9]){12,18}(?![0-9A-Za-z])"
ISSUED = r"^(?:[0-9]{13,19}|[2-6][0-9]{3}([ \-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[0-9]{3}([ \-])[0-9]{6}\2[0-9]{4,5})(?=[ \-]|$)"
PHONE = (
    r"(?<![0-9A-Za-z])\+[1-9][0-9]{0,2}[ .\-]?\(?[0-9]{1,4}\)?(?:[ .\-]?[0-9]{2,4}){2,4}(?![0-9])"
    r"|(?<![0-9A-Za-z])(?:\([0-9]{3}\) ?|[0-9]{3}[.\-])[0-9]{3}[.\-][0-9]{4}(?![0-9A-Za-z])"
)
KINDS = (("email", EMAIL), ("key_id", AWS), ("secret", SECRET), ("date", DATE), ("ssn", SSN), ("ipv4", IPV4), ("iban", IBAN), ("card", CARD), ("phone", PHONE))
MAY_HOLD = r"[0-9@=:]|A[KS]IA"
ANY = "|".join(f"(?:{p})" for _, p in KINDS)


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def _noise(tweak: Column, half: Column, round_: Column, key: str, digits: int = 12) -> Column:
    """A keyed non-negative number from one half of the state."""
    text = F.concat(F.lit(f"{key}|"), tweak, F.lit("|"), round_.cast("string"), F.lit("|"), half.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, digits), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: int | Column, b: int | Column, tweak: str | Column, key: str) -> Column:
    """struct(l, r): a keyed permutation of the pairs with 0 <= l < a and 0 <= r < b."""
    a, b, tweak = (x if isinstance(x, Column) else F.lit(x) for x in (a, b, tweak))

    def step(state: Column, k: Column) -> Column:
        l = F.pmod(state["l"] + _noise(tweak, state["r"], k, key), a).cast("long")
        return F.struct(l.alias("l"), state["r"].alias("r"))

    def back(state: Column, k: Column) -> Column:
        r = F.pmod(state["r"] + _noise(F.concat(tweak, F.lit("'")), state["l"], k, key), b).cast("long")
        return F.struct(state["l"].alias("l"), r.alias("r"))

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda s, k: back(step(s, k), k))


def _shifted(text: Column, by: Column, tweak: str, round_: Column, key: str) -> Column:
    """``text`` with each letter or digit moved within its alphabet by keyed noise from ``by``; the rest stays."""
    noise = F.sha2(F.concat(F.lit(f"{key}|{tweak}|"), round_.cast("string"), F.lit("|"), by), 512)
    digits, lower, upper = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def move(c: Column, i: Column) -> Column:
        n = F.conv(F.substr(noise, F.pmod(i, F.lit(32)) * 4 + 1, F.lit(4)), 16, 10).cast("int")
        out = c
        for alphabet in (upper, lower, digits):
            place = F.instr(F.lit(alphabet), c) - 1
            out = F.when(place >= 0, F.substr(F.lit(alphabet), F.pmod(place + n, F.lit(len(alphabet))) + 1, F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), move), "")


def feistel_text(text: Column, tweak: str, key: str) -> Column:
    """A keyed permutation of the strings with the same character classes at the same places."""
    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substr(text, F.lit(1), half).alias("l"), F.substr(text, half + 1, F.length(text)).alias("r"))

    def step(state: Column, k: Column) -> Column:
        return F.struct(_shifted(state["l"], state["r"], tweak, k, key).alias("l"), state["r"].alias("r"))

    def back(state: Column, k: Column) -> Column:
        return F.struct(state["l"].alias("l"), _shifted(state["r"], state["l"], tweak + "'", k, key).alias("r"))

    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)), start, lambda s, k: back(step(s, k), k))
    return F.concat(done["l"], done["r"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _relaid(layout: Column, digits: Column) -> Column:
    """``layout`` with its digits replaced, in order, by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def put(state: Column, c: Column) -> Column:
        is_digit = c.between("0", "9")
        return F.struct(
            F.concat(state["out"], F.when(is_digit, F.substr(digits, state["at"], F.lit(1))).otherwise(c)).alias("out"),
            F.when(is_digit, state["at"] + 1).otherwise(state["at"]).alias("at"),
        )

    return F.aggregate(F.filter(F.split(layout, ""), lambda c: c != ""), start, put)["out"]


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a digit string; a valid number has a multiple of ten."""

    def add(total: Column, i: Column) -> Column:
        d = F.substr(F.reverse(digits), i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def mod97(text: Column) -> Column:
    """The remainder of the number that the characters spell, letters being 10 to 35."""

    def add(total: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(c.between("0", "9"), total * 10 + c.try_cast("int")).otherwise(total * 100 + letter) % 97

    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), add)


def _iban_valid(hit: Column) -> Column:
    plain = F.regexp_replace(hit, " ", "")
    return mod97(F.concat(F.substr(plain, F.lit(5), F.length(plain)), F.substr(plain, F.lit(1), F.lit(4)))) == 1


def _iban(hit: Column, key: str) -> Column:
    plain = F.regexp_replace(hit, " ", "")
    country, body = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5), F.length(plain))
    valid = _iban_valid(hit)
    check = lambda b: F.lpad((98 - mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0")
    made = _let(feistel_text(body, "iban", key), lambda b: F.concat(country, check(b), b))

    def put(state: Column, c: Column) -> Column:
        kept = c == " "
        return F.struct(F.concat(state["out"], F.when(kept, c).otherwise(F.substr(state["made"], state["at"], F.lit(1)))).alias("out"), F.when(kept, state["at"]).otherwise(state["at"] + 1).alias("at"), state["made"].alias("made"))

    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"), made.alias("made"))
    spaced = F.aggregate(F.filter(F.split(hit, ""), lambda c: c != ""), start, put)["out"]
    return F.when(valid, spaced).otherwise(hit)


def _cut(hit: Column) -> Column:
    """Where to cut a card or account number that was taken with other groups: a length of ``hit``; null if it is to stay whole.

    A card in a layout of issuers at the start of more groups ends there, and one after other groups starts there if the whole
    fails its check. Looser layouts are not tried inside a hit, as one in ten rows of figures would pass for a card. An
    account number that fails its check ends at its longest valid part, or else at its first group.
    """
    until = lambda i: F.substr(hit, F.lit(1), i)
    after = lambda i: F.substr(hit, i + 2, F.length(hit))
    ends = F.filter(F.sequence(F.length(hit) - 1, F.lit(1), F.lit(-1)), lambda i: F.substr(hit, i + 1, F.lit(1)).isin(" ", "-"))

    def issued(text: Column) -> Column:
        card = F.regexp_extract(text, ISSUED, 0)
        return F.when((card != "") & (luhn_sum(_digits(card)) % 10 == 0), F.length(card))

    def card(e: Column) -> Column:
        inner = F.when(luhn_sum(_digits(hit)) % 10 != 0, F.get(F.reverse(F.filter(e, lambda i: issued(after(i)).isNotNull())), F.lit(0)))
        return _let(issued(hit), lambda n: F.when(n < F.length(hit), n).when(n.isNull(), inner))

    def iban(e: Column) -> Column:
        valid = F.filter(e, lambda i: until(i).rlike(f"^(?:{IBAN})$") & _iban_valid(until(i)))
        return F.when(~_iban_valid(hit), F.coalesce(F.get(valid, F.lit(0)), F.element_at(e, -1)))

    is_iban, is_card = hit.rlike(f"^(?:{IBAN})$") & hit.contains(" "), hit.rlike(f"^(?:{CARD})$") & hit.rlike("[ -]")
    return F.when(is_iban, _let(ends, iban)).when(is_card, _let(ends, card))


def _pieces(text: Column) -> Column:
    """``text`` cut so that the search takes no card or account number together with the groups after it.

    The search takes as many groups as a format allows. Where ``_cut`` finds that other groups came along, the text is cut
    there and searched again from there, until nothing is left to cut.
    """

    def cut(state: Column, _: Column) -> Column:
        def again(s: Column) -> Column:
            mark = F.concat(F.lit("\ufdd0"), F.sha2(s, 256))  # no text holds its own digest
            hits = F.concat(F.regexp_extract_all(s, F.lit(ANY), F.lit(0)), F.array(F.lit("")))
            marked = F.transform(hits, lambda h: _let(_cut(h), lambda n: F.when(n.isNull(), h).otherwise(F.concat(F.substr(h, F.lit(1), n), mark, F.substr(h, n + 1, F.length(h))))))
            joined = F.array_join(F.flatten(F.zip_with(F.split(s, ANY, -1), marked, lambda p, h: F.array(p, h))), "")
            return F.split(joined, mark)

        longer = F.flatten(F.transform(state["pieces"], again))
        then = F.struct(longer.alias("pieces"), F.lit(False).alias("done"))
        made = _let(then, lambda t: F.struct(t["pieces"].alias("pieces"), (F.size(t["pieces"]) == F.size(state["pieces"])).alias("done")))
        return F.when(state["done"], state).otherwise(made)

    start = F.struct(F.array(text).alias("pieces"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(CUTS)), start, cut)["pieces"]


def _card(hit: Column, key: str) -> Column:
    digits = _digits(hit)
    body = F.substr(digits, F.lit(2), F.length(digits) - 2)
    head = F.concat(F.substr(digits, F.lit(1), F.lit(1)), feistel_text(body, "card", key))
    made = _let(head, lambda x: F.concat(x, F.pmod(10 - luhn_sum(F.concat(x, F.lit("0"))) % 10, F.lit(10)).cast("string")))
    return F.when(luhn_sum(digits) % 10 == 0, _relaid(hit, made)).otherwise(hit)


def _phone(hit: Column, key: str) -> Column:
    """Area, exchange and line of numbers in the plan of country code 1; else the last digits, ten at most."""
    digits = _digits(hit)
    ten = F.substr(digits, F.greatest(F.length(digits) - 9, F.lit(1)), F.lit(10))
    head = F.substr(digits, F.lit(1), F.length(digits) - F.length(ten))
    area, exchange, line = (F.substr(ten, F.lit(i), F.lit(n)).cast("int") for i, n in ((1, 3), (4, 3), (7, 4)))
    plan = (F.length(ten) == 10) & head.isin("", "1") & (area >= 200) & (exchange >= 200)
    state = feistel((area - 200) * 800 + exchange - 200, line, 640_000, 10_000, "phone", key)
    in_plan = _let(state, lambda s: F.concat((F.floor(s["l"] / 800) + 200).cast("string"), (s["l"] % 800 + 200).cast("string"), F.lpad(s["r"].cast("string"), 4, "0")))
    prefix = F.when(F.substr(hit, F.lit(1), F.lit(1)) == "+", F.least(F.lit(2), F.length(digits) - 6)).otherwise(0)
    free = F.concat(F.substr(digits, F.lit(1), prefix), feistel_text(F.substr(digits, prefix + 1, F.length(digits)), "phone", key))
    return F.when(F.length(digits) < 7, hit).when(plan, _relaid(hit, F.concat(head, in_plan))).otherwise(_relaid(hit, free))


def _ipv4(hit: Column, key: str) -> Column:
    o = [F.split_part(hit, F.lit("."), F.lit(i)).cast("int") for i in (1, 2, 3, 4)]
    state = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "ipv4", key)
    made = _let(state, lambda s: F.concat_ws(".", *(x.cast("string") for x in (F.floor(s["l"] / 256), s["l"] % 256, F.floor(s["r"] / 256), s["r"] % 256))))
    return F.when(F.greatest(*o) <= 255, made).otherwise(hit)


def _ssn(hit: Column, key: str) -> Column:
    area, group, serial = (F.split_part(hit, F.lit("-"), F.lit(i)).cast("int") for i in (1, 2, 3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    state = feistel(F.when(area > 666, area - 2).otherwise(area - 1), (group - 1) * 9999 + serial - 1, 898, 99 * 9999, "ssn", key)

    def show(s: Column) -> Column:
        a = F.when(s["l"] + 1 >= 666, s["l"] + 2).otherwise(s["l"] + 1)
        pad = lambda x, n: F.lpad(x.cast("string"), n, "0")
        return F.concat_ws("-", pad(a, 3), pad(F.floor(s["r"] / 9999) + 1, 2), pad(s["r"] % 9999 + 1, 4))

    return F.when(valid, _let(state, show)).otherwise(hit)


def _permuted_day(year: Column, month: Column, day: Column, short_month: Column, low: Column, short_day: Column, tweak: Column, key: str) -> Column:
    """struct(y, m, d): a keyed permutation of the dates of 200 years with months up to 12 (``short_month``: 9) and days from ``low`` (``short_day``: up to 9).

    Days up to 28 are in every month; the 29th, 30th and 31st each move among the months, and 29 February among the leap years
    (49 from 1904 to 2096), that have them.
    """
    y, leap, late = year - FIRST_YEAR, (month == 2) & (day == 29), day > 28
    held = F.when(day == 31, F.array(*(F.lit(m) for m in (1, 3, 5, 7, 8, 10, 12)))).when(late, F.array(*(F.lit(m) for m in (1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12)))).otherwise(F.sequence(F.lit(1), F.lit(12)))

    def moved(months: Column) -> Column:
        n, place = F.size(months), F.array_position(months, month) - 1
        nth = F.floor((year - 1904) / 4)
        start = F.struct(
            F.when(leap, F.floor(nth / 7)).when(late, y).otherwise(y * n + place).cast("long").alias("l"), F.when(leap, nth % 7).when(late, place).otherwise(day - low).cast("long").alias("r"),
            F.when(leap, 7).when(late, YEARS).otherwise(n * YEARS).alias("a"), F.when(leap, 7).when(late, n).otherwise(F.when(short_day, 9).otherwise(28) - low + 1).alias("b"),
        )
        made = _let(start, lambda x: feistel(x["l"], x["r"], x["a"], x["b"], F.concat(tweak, x["a"].cast("string"), F.lit("."), x["b"].cast("string"), F.when(late, F.concat(F.lit("."), day.cast("string"))).otherwise("")), key))

        def date(s: Column) -> Column:
            in_order = F.when(late, s["l"]).otherwise(F.floor(s["l"] / n)) + FIRST_YEAR
            which = F.get(months, F.when(late, s["r"]).otherwise(s["l"] % n).cast("int"))
            return F.struct(
                F.when(leap, (s["l"] * 7 + s["r"]) * 4 + 1904).otherwise(in_order).cast("long").alias("y"), F.when(leap, 2).otherwise(which).cast("long").alias("m"),
                F.when(late, day).otherwise(s["r"] + low).cast("long").alias("d"),
            )

        return _let(made, date)

    return _let(F.filter(held, lambda m: ~short_month | (m <= 9)), moved)


def _date(hit: Column, key: str) -> Column:
    """ISO dates, day.month.year, and month/day/year or, where that is no date, day/month/year; padding stays.

    A date moves only among those that the same layout shows with as many digits, so no two texts share a pseudonym.
    """
    iso, dotted = hit.contains("-"), hit.contains(".")
    parts = F.split(hit, r"[-./]")
    one, two, three = (F.get(parts, F.lit(k)) for k in range(3))
    a, b, c = (x.try_cast("int") for x in (one, two, three))
    valid = lambda y, m, d: F.try_make_timestamp(y, m, d, F.lit(0), F.lit(0), F.lit(0)).isNotNull() & y.between(FIRST_YEAR, FIRST_YEAR + YEARS - 1)
    month_first = ~iso & ~dotted & valid(c, a, b)
    year, month, day = F.when(iso, a).otherwise(c), F.when(iso, b).when(month_first, a).otherwise(b), F.when(iso, c).when(month_first, b).otherwise(a)
    short = lambda text: F.length(text) == 1
    short_month = F.when(iso, False).when(month_first, short(one)).otherwise(short(two))
    short_day = F.when(iso, False).when(month_first, short(two)).otherwise(short(one))
    name = F.when(iso, "iso").when(dotted, "dot").when(month_first, "month").otherwise("day")
    low = F.when(iso | dotted | month_first, 1).otherwise(13)
    state = _permuted_day(year, month, day, short_month, low, short_day, name, key)

    def show(s: Column) -> Column:
        m = F.when(short_month, s["m"].cast("string")).otherwise(F.lpad(s["m"].cast("string"), 2, "0"))
        d = F.when(short_day, s["d"].cast("string")).otherwise(F.lpad(s["d"].cast("string"), 2, "0"))
        y = s["y"].cast("string")
        return F.when(iso, F.concat_ws("-", y, m, d)).when(dotted, F.concat_ws(".", d, m, y)).when(month_first, F.concat_ws("/", m, d, y)).otherwise(F.concat_ws("/", d, m, y))

    return F.when(valid(year, month, day), F.coalesce(_let(state, show), hit)).otherwise(hit)


def _email(hit: Column, key: str) -> Column:
    return F.concat(feistel_text(F.split_part(hit, F.lit("@"), F.lit(1)), "email", key), F.lit("@"), F.split_part(hit, F.lit("@"), F.lit(2)))


def _tail(hit: Column, key: str) -> Column:
    """The last run of a credential's characters."""
    value = F.regexp_extract(hit, r"[A-Za-z0-9+/_\-]+$", 0)
    return F.concat(F.substr(hit, F.lit(1), F.length(hit) - F.length(value)), feistel_text(value, "secret", key))


def _key_id(hit: Column, key: str) -> Column:
    return F.concat(F.substr(hit, F.lit(1), F.lit(4)), feistel_text(F.substr(hit, F.lit(5), F.length(hit)), "key_id", key))


_MAKE = {"email": _email, "key_id": _key_id, "secret": _tail, "date": _date, "ssn": _ssn, "ipv4": _ipv4, "iban": _iban, "card": _card, "phone": _phone}


def pseudonym(hit: Column, key: str) -> Column:
    """struct(kind, value) of one found value."""
    kind, value = F.lit(None).cast("string"), hit
    for name, pattern in reversed(KINDS):
        # Inside a value there is nothing around it, so the look-arounds hold and only the shape counts.
        fits = hit.rlike(f"^(?:{pattern})$")
        kind = F.when(fits, name).otherwise(kind)
        value = F.when(fits, _MAKE[name](hit, key)).otherwise(value)
    return F.struct(kind.alias("kind"), value.alias("value"))


def findings(columns: list[str]) -> str:
    """The name of the column of findings besides these columns."""
    name = "pii"
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def pseudonymise(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """``docs`` with ``column`` pseudonymised and an array of (kind, value) of what was changed."""
    if not key:
        raise ValueError("pseudonyms need a key")
    own = docs.columns
    at = own.index(column)
    found = docs.toDF(*(f"_c{k}" for k in range(len(own))))  # names of this function's own cannot clash with these
    text = F.col(f"_c{at}")
    # Every kind needs a digit, an @, the sign after a credential word or the start of a key id; texts without skip the search.
    hits = F.when(text.rlike(MAY_HOLD), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    found = found.withColumn("_hits", hits).withColumn("_parts", F.when(F.size("_hits") > 0, F.split(text, ANY, -1)))
    # Few texts have a card or account number that fails its check; only they are cut and searched in pieces.
    found = found.withColumn("_pieces", F.when(F.exists("_hits", lambda h: _cut(h).isNotNull()), _pieces(text)))
    end = F.array(F.lit(""))
    by_piece = F.flatten(F.transform("_pieces", lambda s: F.concat(F.regexp_extract_all(s, F.lit(ANY), F.lit(0)), end)))
    found = found.withColumns({
        "_hits": F.when(F.col("_pieces").isNotNull(), by_piece).otherwise(F.concat("_hits", end)),
        "_parts": F.when(F.col("_pieces").isNotNull(), F.flatten(F.transform("_pieces", lambda s: F.split(s, ANY, -1)))).otherwise(F.col("_parts")),
    })
    found = found.withColumn("_made", F.when(F.size("_hits") > 1, F.transform("_hits", lambda h: F.when(h != "", pseudonym(h, key)).otherwise(F.struct(F.lit(None).cast("string").alias("kind"), h.alias("value"))))))
    joined = F.array_join(F.flatten(F.zip_with("_parts", F.transform("_made", lambda m: m["value"]), lambda p, v: F.array(p, v))), "")
    changed = F.filter(F.zip_with("_hits", "_made", lambda h, m: F.when(h != m["value"], m)), lambda m: m.isNotNull())
    empty = F.array().cast("array<struct<kind:string,value:string>>")
    out = found.withColumn("_text", F.when(F.col("_made").isNotNull(), joined).otherwise(text)).withColumn("_pii", F.when(F.col("_made").isNotNull(), changed).otherwise(empty))
    return out.select(*(F.col("_text" if k == at else f"_c{k}").alias(c) for k, c in enumerate(own)), F.col("_pii").alias(findings(own)))


def session_key(spark: SparkSession) -> str:
    return spark.conf.get(KEY_SETTING, None) or DEMO_KEY


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = pseudonymise(docs, session_key(spark))
    return found.select("doc_id", "text", F.size("pii").cast("long").alias("n_pii"), F.array_join(F.array_sort(F.array_distinct("pii.kind")), ",").alias("kinds"))
