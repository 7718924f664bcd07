"""Personal data under format-preserving pseudonyms, in DataFrame functions alone.

Numbers and dates are found by pattern and validated (check digits, octets, calendar,
number ranges; phone numbers by their digits alone).  A value is read as a place in the set of values of its format, and a
keyed Feistel network permutes that set: the pseudonym has the same format and passes
the same validation, equal values get equal pseudonyms in all documents, different
values different ones, and the key undoes it.  The halves of the set are residues of
unequal moduli, so no value has to be walked back into range.

Kinds: e-mail addresses (local part), IPv4 addresses (octets keep their widths), ISO and dotted or slashed dates
from 1900 to 2099, US social security numbers, phone numbers, payment card numbers (13 to
19 digits with a Luhn digit; the first digit stays), IBANs (digits of the account).

Defined cases: a null text stays null, an empty text empty; a value that fails its
validation stays as it is; a day and month that may be read both ways is read day first,
one that is readable only month first stays so, and each field keeps its number of digits;
repeated values and rows get equal results; a null doc_id stays null; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

#: Patterns by kind, tried in this order at each place of a text.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
    "date": r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?!\d|[/.-]\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?!-?\d)",
    "us_phone": r"(?<!\d)(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)",
    "phone": r"\+[2-9]\d{0,2}(?:[ .-]?\(?\d{2,4}\)?){2,5}(?!\d)",
    "card": r"(?<!\d)(?:\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?!\d)",
}
ANY = "|".join(f"(?:{pattern})" for pattern in PATTERNS.values())


def feistel(
    value: Column, low: Column | int, high: Column | int, tweak: Column, key: str, undo: bool = False
) -> Column:
    """A keyed permutation of the numbers from 0 to low * high - 1."""
    low = F.lit(low).cast("long") if isinstance(low, int) else low
    high = F.lit(high).cast("long") if isinstance(high, int) else high

    def noise(turn: Column, half: Column) -> Column:
        text = F.concat_ws("|", F.lit(key), tweak, turn.cast("string"), half.cast("string"))
        return F.conv(F.substring(F.sha2(text, 256), 1, 14), 16, 10).cast("long")

    def turn(state: Column, number: Column) -> Column:
        left, right = state["left"], state["right"]
        sign = F.lit(-1 if undo else 1)
        odd = number % 2 == 1
        return F.struct(
            F.when(odd, F.pmod(left + sign * noise(number, right), low)).otherwise(left).alias("left"),
            F.when(odd, right).otherwise(F.pmod(right + sign * noise(number, left), high)).alias("right"),
        )

    start = F.struct((value % low).alias("left"), F.floor(value / low).cast("long").alias("right"))
    turns = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if undo else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(turns, start, turn, lambda state: state["left"] + state["right"] * low)


def digit_feistel(digits: Column, tweak: Column, key: str, undo: bool = False) -> Column:
    """A keyed permutation of digit strings of each length from 2 to 34."""
    size = F.length(digits)
    cut = F.floor(size / 2).cast("int")
    low, high = (F.pow(F.lit(10), n).cast("long") for n in (cut, size - cut))
    halves = F.struct(
        F.substr(digits, F.lit(1), cut).cast("long").alias("left"),
        F.substr(digits, cut + 1).cast("long").alias("right"),
    )

    def noise(turn: Column, half: Column) -> Column:
        text = F.concat_ws("|", F.lit(key), tweak, size.cast("string"), turn.cast("string"), half.cast("string"))
        return F.conv(F.substring(F.sha2(text, 256), 1, 14), 16, 10).cast("long")

    def turn(state: Column, number: Column) -> Column:
        left, right = state["left"], state["right"]
        sign = F.lit(-1 if undo else 1)
        odd = number % 2 == 1
        return F.struct(
            F.when(odd, F.pmod(left + sign * noise(number, right), low)).otherwise(left).alias("left"),
            F.when(odd, right).otherwise(F.pmod(right + sign * noise(number, left), high)).alias("right"),
        )

    turns = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if undo else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(
        turns,
        halves,
        turn,
        lambda s: F.concat(
            F.lpad(s["left"].cast("string"), cut, F.lit("0")),
            F.lpad(s["right"].cast("string"), size - cut, F.lit("0")),
        ),
    )


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def _refill(text: Column, digits: Column) -> Column:
    """The text with its digits replaced one by one."""
    return F.array_join(
        F.transform(
            F.sequence(F.lit(1), F.length(text)),
            lambda i: F.when(
                text.substr(i, F.lit(1)).rlike("[0-9]"),
                digits.substr(F.length(_digits(text.substr(F.lit(1), i))), F.lit(1)),
            ).otherwise(text.substr(i, F.lit(1))),
        ),
        "",
    )


def _letters(text: Column, tweak: str, key: str, undo: bool) -> Column:
    """A keyed permutation of strings of one pattern of letters, digits and other signs.

    Two halves of the string in turn shift each other's letters and digits by a stream
    keyed by the fixed half; a string of one sign is shifted by the key alone.
    """
    size = F.length(text)
    cut = F.floor((size + 1) / 2).cast("int")

    def shift(part: Column, other: Column, turn: Column) -> Column:
        seed = F.sha2(
            F.concat_ws("|", F.lit(key), F.lit(tweak), size.cast("string"), turn.cast("string"), other), 256
        )

        def sign(i: Column) -> Column:
            own = part.substr(i, F.lit(1))
            code = F.ascii(own)
            noise = F.conv(F.substring(F.sha2(F.concat_ws("|", seed, i.cast("string")), 256), 1, 8), 16, 10).cast("long")
            move = -noise if undo else noise

            def within(first: str, count: int) -> Column:
                return F.char(F.pmod(code - ord(first) + move, F.lit(count)) + ord(first))

            return (
                F.when(own.rlike("[a-z]"), within("a", 26))
                .when(own.rlike("[A-Z]"), within("A", 26))
                .when(own.rlike("[0-9]"), within("0", 10))
                .otherwise(own)
            )

        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(part)), sign), "")

    def turn(state: Column, number: Column) -> Column:
        left, right = state["left"], state["right"]
        odd = number % 2 == 1
        return F.struct(
            F.when(odd, shift(left, right, number)).otherwise(left).alias("left"),
            F.when(odd | (F.length(right) == 0), right).otherwise(shift(right, left, number)).alias("right"),
        )

    start = F.struct(text.substr(F.lit(1), cut).alias("left"), F.substr(text, cut + 1).alias("right"))
    turns = F.sequence(F.lit(4), F.lit(1), F.lit(-1)) if undo else F.sequence(F.lit(1), F.lit(4))
    return F.aggregate(turns, start, turn, lambda s: F.concat(s["left"], s["right"]))


def _email(text: Column, key: str, undo: bool) -> Column:
    return F.concat(
        _letters(F.substring_index(text, "@", 1), "email", key, undo),
        F.lit("@"),
        F.substring_index(text, "@", -1),
    )


def _ip(text: Column, key: str, undo: bool) -> Column:
    """Each octet keeps its width and whether a zero leads it, so no two spellings meet."""

    def octet(shown: Column) -> Column:
        zero = shown.rlike("^0.")
        width = F.length(shown) - zero.cast("int")
        base = F.when(zero | (width == 1), 0).when(width == 2, 10).otherwise(100)
        size = F.when(width == 1, 10).when(zero, 100).when(width == 2, 90).otherwise(156)
        return F.struct(
            F.length(shown).alias("length"),
            base.cast("long").alias("base"),
            size.cast("long").alias("size"),
            (shown.cast("long") - base).alias("place"),
        )

    def permuted(octets: Column) -> Column:
        size, place = octets["size"], octets["place"]
        left, right = place[0] * size[1] + place[1], place[2] * size[3] + place[3]
        low, high = size[0] * size[1], size[2] * size[3]
        tweak = F.concat(F.lit("ip"), F.array_join(size.cast("array<string>"), "."))
        new = feistel(left * high + right, low, high, tweak, key, undo)
        return F.transform(F.array(new), lambda n: shown(octets, n))[0]

    def shown(octets: Column, new: Column) -> Column:
        size = octets["size"]
        steps = [size[1] * size[2] * size[3], size[2] * size[3], size[3], F.lit(1)]
        values = [F.floor(new / step) % size[k] + octets["base"][k] for k, step in enumerate(steps)]
        return F.concat_ws(
            ".",
            *[F.lpad(value.cast("string"), octets["length"][k], F.lit("0")) for k, value in enumerate(values)],
        )

    parts = F.split(text, r"\.")
    new = F.transform(F.array(F.transform(parts, octet)), permuted)[0]
    return F.when(F.forall(parts, lambda x: x.cast("long") <= 255), new).otherwise(text)


FIRST_YEAR, YEARS = 1900, 200
MONTH_DAYS = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)
#: 200 years of days are 73,049; halves of one more (see ``_date``).
DAYS = (150, 487)
#: Sets of dates by (first day, last day, last month): first the days of the month that a
#: field of one or two digits holds, day first; then those readable only month first.
DATE_SETS = {
    (1, 31, 12): DAYS,
    (1, 31, 9): (211, 259),
    (1, 9, 12): (144, 150),
    (1, 9, 9): (120, 135),
    (13, 31, 12): (177, 250),
    (13, 31, 9): (50, 661),
}


def _year_starts(low: int, high: int, months: int, leap: bool) -> list[int]:
    """Days of the set before each month of a year, and in all."""
    starts = [0]
    for month, size in enumerate(MONTH_DAYS[:months], 1):
        starts.append(starts[-1] + min(high, size + (leap and month == 2)) - low + 1)
    return starts


def _leap(at: Column) -> Column:
    """Whether the year that many after FIRST_YEAR has a 29 February (1900 has none)."""
    return (at % 4 == 0) & (at > 0)


def _fields(text: Column) -> Column:
    """The text's fields as written, and its mark."""
    iso = text.rlike(r"^\d{4}-")
    parts = F.split(text, r"[-/.]")
    return F.struct(
        F.when(iso, parts[2]).otherwise(parts[0]).alias("one"),
        parts[1].alias("two"),
        F.when(iso, parts[0]).otherwise(parts[2]).alias("year"),
        F.when(iso, "-").when(text.contains("/"), "/").otherwise(".").alias("mark"),
    )


def _read(own: Column) -> Column:
    """Year, month, day and the set's number (null if there is no such date)."""

    def exists(month: str, day: str) -> Column:
        padded = F.concat_ws("-", own["year"], F.lpad(own[month], 2, "0"), F.lpad(own[day], 2, "0"))
        return F.try_to_date(padded, "yyyy-MM-dd").isNotNull()

    short_one, short_two = F.length(own["one"]) == 1, F.length(own["two"]) == 1
    day_first = F.when(short_one, F.when(short_two, 3).otherwise(2)).otherwise(F.when(short_two, 1).otherwise(0))
    month_first = F.when(short_one, 5).otherwise(4)
    kind = F.when(exists("two", "one"), day_first).when(
        (own["mark"] != "-") & exists("one", "two"), month_first
    )
    return F.struct(
        *[own[name].alias(name) for name in ("one", "two", "mark")],
        (own["year"].cast("int") - FIRST_YEAR).alias("at"),
        kind.alias("kind"),
    )


def _with_set(own: Column) -> Column:
    """The same with the numbers of its set of dates."""

    def of(values: list) -> Column:
        return F.array(*[F.lit(value) for value in values])[own["kind"]]

    starts = {
        leap: [_year_starts(*dates, leap) for dates in DATE_SETS] for leap in (False, True)
    }
    sizes = [
        sum(long[-1] if y and y % 4 == 0 else plain[-1] for y in range(YEARS))
        for plain, long in zip(starts[False], starts[True], strict=True)
    ]
    late = own["kind"] >= 4
    return F.struct(
        *[own[name].alias(name) for name in ("one", "two", "mark", "at", "kind")],
        late.alias("late"),
        F.when(late, own["one"]).otherwise(own["two"]).cast("int").alias("month"),
        F.when(late, own["two"]).otherwise(own["one"]).cast("int").alias("day"),
        of([dates[0] for dates in DATE_SETS]).alias("first_day"),
        of([plain[-1] for plain in starts[False]]).alias("per_year"),
        of([b[-1] - a[-1] for a, b in zip(starts[False], starts[True], strict=True)]).alias("grows"),
        of([low for low, _ in DATE_SETS.values()]).cast("long").alias("low"),
        of([high for _, high in DATE_SETS.values()]).cast("long").alias("high"),
        of(sizes).alias("size"),
        *[
            F.array(*[F.array(*map(F.lit, part)) for part in starts[leap]])[own["kind"]].alias(name)
            for leap, name in ((False, "plain"), (True, "leap"))
        ],
    )


def _date(text: Column, key: str, undo: bool) -> Column:
    """A date is its rank in its set; fields keep their numbers of digits and their order.

    Where a set has one date less than the Feistel network has numbers, the number left
    over is passed by with a second turn.  Arrays of one element bind a value to a name,
    so that it is computed once.
    """

    def before(own: Column, at: Column) -> Column:
        return own["per_year"] * at + own["grows"] * F.greatest(F.floor((at - 1) / 4), F.lit(0))

    def turned(own: Column, value: Column) -> Column:
        tweak = F.concat(F.lit("date"), own["kind"].cast("string"))
        return feistel(value, own["low"], own["high"], tweak, key, undo)

    def ranked(own: Column) -> Column:
        begins = F.when(_leap(own["at"]), own["leap"]).otherwise(own["plain"])
        rank = before(own, own["at"]) + begins[own["month"] - 1] + own["day"] - own["first_day"]
        return F.struct(own.alias("own"), rank.cast("long").alias("rank"))

    def moved(state: Column) -> Column:
        return F.struct(state["own"].alias("own"), turned(state["own"], state["rank"]).alias("rank"))

    def walked(state: Column) -> Column:
        again = F.when(state["rank"] == state["own"]["size"], turned(state["own"], state["rank"]))
        rank = again.otherwise(state["rank"])
        return F.struct(state["own"].alias("own"), rank.alias("rank"))

    def in_year(state: Column) -> Column:
        guess = F.floor(state["rank"] / state["own"]["per_year"])
        at = F.when(before(state["own"], guess) > state["rank"], guess - 1).otherwise(guess)
        return F.struct(state["own"].alias("own"), state["rank"].alias("rank"), at.alias("at"))

    def in_month(state: Column) -> Column:
        own, at = state["own"], state["at"]
        begins = F.when(_leap(at), own["leap"]).otherwise(own["plain"])
        left = state["rank"] - before(own, at)
        return F.struct(own.alias("own"), at.alias("at"), left.alias("left"), begins.alias("begins"))

    def found(state: Column) -> Column:
        month = F.size(F.filter(state["begins"], lambda x: x <= state["left"]))
        day = state["left"] - state["begins"][month - 1] + state["own"]["first_day"]
        return F.struct(state["own"].alias("own"), state["at"].alias("at"), month.alias("month"), day.alias("day"))

    def shown(state: Column) -> Column:
        own = state["own"]

        def field(name: str, late: str, early: str) -> Column:
            value = F.when(own["late"], state[late]).otherwise(state[early]).cast("string")
            return F.lpad(value, F.length(own[name]), F.lit("0"))

        one, two = field("one", "month", "day"), field("two", "day", "month")
        year = (state["at"] + FIRST_YEAR).cast("string")
        return F.when(own["mark"] == "-", F.concat_ws("-", year, two, one)).otherwise(
            F.concat(one, own["mark"], two, own["mark"], year)
        )

    known = F.filter(
        F.transform(F.transform(F.array(text), _fields), _read),
        lambda own: own["kind"].isNotNull() & own["at"].between(0, YEARS - 1),
    )
    steps = known
    for step in (_with_set, ranked, moved, walked, in_year, in_month, found, shown):
        steps = F.transform(steps, step)
    return F.coalesce(F.get(steps, F.lit(0)), text)


def _ssn(text: Column, key: str, undo: bool) -> Column:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = (F.split(text, "-")[k].cast("long") for k in range(3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = ((area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1) * 9999 + serial - 1
    new = feistel(index, 898 * 11, 9 * 9999, F.lit("ssn"), key, undo)
    new_area = F.floor(new / (99 * 9999)) + 1
    new_area = new_area + (new_area >= 666).cast("int")
    shown = F.format_string(
        "%03d-%02d-%04d",
        new_area.cast("long"),
        (F.floor(new / 9999) % 99 + 1).cast("long"),
        (new % 9999 + 1).cast("long"),
    )
    return F.when(valid, shown).otherwise(text)


def _us_phone(text: Column, key: str, undo: bool) -> Column:
    """Ten digits; a leading 1 is the country and stays."""
    digits = _digits(text)
    country = F.when(F.length(digits) == 11, F.lit("1")).otherwise(F.lit(""))
    new = digit_feistel(F.substring(digits, -10, 10), F.lit("us_phone"), key, undo)
    return _refill(text, F.concat(country, new))


def _phone(text: Column, key: str, undo: bool) -> Column:
    """Digits after the country's; up to three digits before the first break stay."""
    country = F.length(F.regexp_extract(text, r"^\+(\d{1,3})(?=[ .(-])|^\+(\d\d)", 0)) - 1
    digits = _digits(text)
    own = F.substr(digits, country + 1)
    return _refill(
        text, F.concat(digits.substr(F.lit(1), country), digit_feistel(own, F.lit("phone"), key, undo))
    )


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _card(text: Column, key: str, undo: bool) -> Column:
    digits = _digits(text)
    size = F.length(digits)
    body = F.concat(
        F.substring(digits, 1, 1),
        digit_feistel(digits.substr(F.lit(2), size - 2), F.substring(digits, 1, 1), key, undo),
    )
    ends = F.array(*[F.lit(str(d)) for d in range(10)])
    whole = F.filter(F.transform(ends, lambda d: F.concat(body, d)), lambda x: _luhn(x))[0]
    return F.when(_luhn(digits), _refill(text, whole)).otherwise(text)


def _mod97(text: Column) -> Column:
    signs = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.ascii(text.substr(i, F.lit(1))).cast("long"))
    return F.aggregate(
        signs,
        F.lit(0).cast("long"),
        lambda a, x: F.when(x < 58, (a * 10 + x - 48) % 97).otherwise((a * 100 + x - 55) % 97),
    )


def _iban(text: Column, key: str, undo: bool) -> Column:
    """The account's digits are permuted, its letters stay, the check digits follow."""
    plain = F.regexp_replace(text, " ", "")
    country, account = F.substring(plain, 1, 2), F.substr(plain, F.lit(5))
    digits = _digits(account)
    new = _refill(account, digit_feistel(digits, F.concat(F.lit("iban"), country), key, undo))
    check = F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
    valid = (_mod97(F.concat(account, F.substring(plain, 1, 4))) == 1) & (F.length(digits) >= 2)
    return F.when(valid, _refill(text, F.concat(check, _digits(new)))).otherwise(text)


KINDS: dict[str, Callable[[Column, str, bool], Column]] = {
    "email": _email,
    "iban": _iban,
    "ip": _ip,
    "date": _date,
    "ssn": _ssn,
    "us_phone": _us_phone,
    "phone": _phone,
    "card": _card,
}


def pseudonym(value: Column, key: str, undo: bool = False) -> Column:
    """The pseudonym of one found value, by the first kind whose pattern it has."""
    chosen = F.when(F.lit(False), value)
    for kind, pattern in PATTERNS.items():
        chosen = chosen.when(value.rlike(f"^(?:{pattern})$"), KINDS[kind](value, key, undo))
    return chosen.otherwise(value)


def pseudonymised(docs: DataFrame, key: str, undo: bool = False) -> DataFrame:
    """doc_id, the text under pseudonyms, how many values were found and how many replaced.

    ``undo`` takes pseudonyms back to the values under the same key.
    """
    text = F.col("text").cast("string")
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).alias("values"),
    )
    cut = found.select(
        "doc_id",
        "text",
        "values",
        F.when(F.size("values") > 0, F.split("text", ANY, -1)).alias("parts"),
        F.when(
            F.size("values") > 0, F.transform("values", lambda value: pseudonym(value, key, undo))
        ).alias("new"),
    )
    joined = F.array_join(
        F.zip_with("parts", "new", lambda part, new: F.concat(part, F.coalesce(new, F.lit("")))), ""
    )
    changed = F.filter(F.zip_with("values", "new", lambda a, b: a != b), lambda x: x)
    return cut.select(
        "doc_id",
        F.when(F.col("parts").isNotNull(), joined).otherwise(F.col("text")).alias("text"),
        F.coalesce(F.when(F.size("values") >= 0, F.size("values")), F.lit(0)).cast("long").alias("n_found"),
        F.coalesce(F.when(F.col("parts").isNotNull(), F.size(changed)), F.lit(0)).cast("long").alias("n_replaced"),
    )
