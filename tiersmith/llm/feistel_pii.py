"""Format-preserving pseudonyms: personal numbers and dates are permuted by a keyed Feistel network.

A value is found by its pattern, validated (check digit, calendar, number ranges), mapped to its index
among all valid values of the same format, permuted there and written back in the same format. The
permutation depends on key and format only, so equal values stay linked across documents and
different ones never meet. Mail addresses have no such index: their name becomes a keyed digest.

Formats: payment card numbers (13 to 19 digits, Luhn; blanks and hyphens stay), social security
numbers, phone numbers (a country code set off by a blank, hyphen or bracket stays), IPv4 addresses, dates ``yyyy-mm-dd`` and ``dd.mm.yyyy``
from 1900 to 2099.

Card numbers in one of their usual shapes are looked for at every group of digits and validated before
anything else is matched, so digits beside a card neither hide it nor become part of it. What another
pattern finds but validation rejects is searched inside, from the first group of digits on and longest
first, for a card or phone number; the rest of it stays as it is.

Everything is SQL expressions on the row, without shuffle. Defined cases: a null text stays null, an
empty one empty; repeated rows get equal results; texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiersmith.llm.scratch import stored

ROUNDS = 10
# In this order: an alternative that comes first wins where two match. Bounded repeats and starts
# behind a boundary keep the search linear in the length of the text.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "iso_date": r"(?<![0-9-])(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}(?![0-9]|-[0-9])",
    "dotted_date": r"(?<![0-9.])[0-9]{2}\.[0-9]{2}\.(?:19|20)[0-9]{2}(?![0-9]|\.[0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    # A North American number has its exact shape, so that it does not take digits of what follows it.
    "phone": (
        r"(?<![0-9+])(?:(?:\+1[ -]?)?\([0-9]{3}\)[ -]?[0-9]{3}[ -]?[0-9]{4}|\+1[ -]?[0-9]{3}[ -]?[0-9]{3}[ -]?[0-9]{4}"
        r"|\+[0-9]{1,3}[ -]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ -]?[0-9]{2,4}){2,4})(?![0-9])"
    ),
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
ANY = "|".join(PATTERNS.values())
# Cards as they are mostly written: 4-4-4-4, 4-6-5, unbroken. Not right behind a country code, where an
# unbroken number is a phone's, and not in a mail address.
CARD_SHAPES = r"[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19}"
BEFORE_CARD = r"(?<![0-9])(?<!\+[0-9]{0,3}[ -]?)(?<!@[A-Za-z0-9.-]{0,63})"
BEHIND_CARD = r"(?![0-9]|[A-Za-z0-9._%+-]{0,63}@)"
# Zero-width, so that also shapes that overlap are found: the first group holds what may be a card.
CARD_STARTS = rf"{BEFORE_CARD}(?=((?:{CARD_SHAPES}){BEHIND_CARD}))"


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# The column that holds the key while a text is worked on.
KEY = "__key"


def spoken(key: str) -> str:
    """A key as SQL: the column, or a literal."""
    return key if key == KEY else quoted(key)


def feistel(x: str, a: str, b: str, tweak: str, key: str) -> str:
    """The permutation of ``x`` among the numbers under ``a * b``, two unequal halves in turns."""

    def noise(half: str) -> str:
        digest = f"sha2(concat_ws(':', {spoken(key)}, {tweak}, i, {half}), 256)"
        return f"cast(conv(substring({digest}, 1, 14), 16, 10) AS long)"

    return (
        f"aggregate(sequence(0, {ROUNDS - 1}), named_struct('l', ({x}) div ({b}), 'r', ({x}) % ({b})),"
        f" (s, i) -> if(i % 2 = 0,"
        f" named_struct('l', pmod(s.l + {noise('s.r')} % ({a}), {a}), 'r', s.r),"
        f" named_struct('l', s.l, 'r', pmod(s.r + {noise('s.l')} % ({b}), {b}))),"
        f" s -> s.l * ({b}) + s.r)"
    )


def digits(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def number(text: str) -> str:
    return f"cast({text} AS long)"


def power(n: str) -> str:
    return f"cast(pow(10, {n}) AS long)"


def permuted_digits(d: str, tweak: str, key: str) -> str:
    """A string of up to 18 digits permuted among all of its length."""
    n = f"length({d})"
    return f"lpad(cast({feistel(number(d), power(f'{n} div 2'), power(f'{n} - {n} div 2'), f'concat({quoted(tweak)}, {n})', key)} AS string), {n}, '0')"


def luhn_sum(d: str, first_doubled: int) -> str:
    """Sum of the digits, those at an odd (1) or even (0) distance from the right end doubled."""
    digit = f"cast(substring({d}, length({d}) - p, 1) AS long)"
    return (
        f"aggregate(sequence(0, length({d}) - 1), 0L, (t, p) -> t +"
        f" if(p % 2 = {first_doubled}, ({digit} * 2) div 10 + ({digit} * 2) % 10, {digit}))"
    )


def refilled(m: str, d: str) -> str:
    """``m`` with its digits replaced by those of ``d`` in turn."""
    at = f"substring({m}, c, 1)"
    nth = f"length(regexp_replace(substring({m}, 1, c), '[^0-9]', ''))"
    return f"array_join(transform(sequence(1, length({m})), c -> if({at} BETWEEN '0' AND '9', substring({d}, {nth}, 1), {at})), '')"


def pseudonym_cases(m: str, key: str) -> dict[str, tuple[str, str]]:
    """For each kind a test for valid values and the pseudonym of such a value."""
    day = "date_diff({}, DATE'1900-01-01')"
    # The days of the 200 years, as a product of two factors.
    days = (17, 4297)

    def date(layout: str) -> tuple[str, str]:
        parsed = f"cast(try_to_timestamp({m}, '{layout}') AS date)"
        new = feistel(f"cast({day.format(parsed)} AS long)", f"{days[0]}L", f"{days[1]}L", "'date'", key)
        return f"{parsed} IS NOT NULL", f"date_format(date_add(DATE'1900-01-01', cast({new} AS int)), '{layout}')"

    octet = lambda i: f"cast(split_part({m}, '.', {i}) AS long)"
    ip = " + ".join(f"{octet(i)} * {1 << (8 * (4 - i))}L" for i in range(1, 5))
    new_ip = feistel(ip, "65536L", "65536L", "'ip'", key)
    dotted = f"transform(array({new_ip}), v -> concat_ws('.', shiftright(v, 24), shiftright(v, 16) & 255, shiftright(v, 8) & 255, v & 255))[0]"

    area, group, serial = (f"cast(split_part({m}, '-', {i}) AS long)" for i in (1, 2, 3))
    # Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999.
    ssn = f"(({area} - 1 - if({area} > 666, 1, 0)) * 99 + {group} - 1) * 9999 + {serial} - 1"
    new_ssn = feistel(ssn, f"{898 * 99}L", "9999L", "'ssn'", key)
    new_area = "v div (99 * 9999) + 1 + if(v div (99 * 9999) + 1 >= 666, 1, 0)"
    written = (
        f"transform(array({new_ssn}), v -> concat_ws('-', lpad(cast({new_area} AS string), 3, '0'),"
        f" lpad(cast((v div 9999) % 99 + 1 AS string), 2, '0'), lpad(cast(v % 9999 + 1 AS string), 4, '0')))[0]"
    )

    d = digits(m)
    body = f"substring({d}, 1, length({d}) - 1)"
    # Without the check digit, its neighbour is the first to be doubled.
    card = f"transform(array({permuted_digits(body, 'card', key)}), v -> concat(v, cast((10 - {luhn_sum('v', 0)} % 10) % 10 AS string)))[0]"

    code = f"regexp_extract({m}, '^(\\\\+[0-9]{{1,3}})[ (-]', 1)"
    rest = f"substring({m}, length({code}) + 1)"
    phone = f"concat({code}, {refilled(rest, permuted_digits(digits(rest), 'phone', key))})"

    name = f"substring(sha2(concat_ws(':', {spoken(key)}, 'email', lower({m})), 256), 1, 16)"
    email = f"concat('u', {name}, '@', substring_index({m}, '@', -1))"
    return {
        "email": ("true", email),
        "iso_date": date("yyyy-MM-dd"),
        "dotted_date": date("dd.MM.yyyy"),
        "ip": (f"greatest({', '.join(octet(i) for i in range(1, 5))}) <= 255", dotted),
        "ssn": (f"{area} BETWEEN 1 AND 899 AND {area} <> 666 AND {group} > 0 AND {serial} > 0", written),
        "phone": (f"length({d}) BETWEEN 7 AND 15", phone),
        "card": (f"length({d}) BETWEEN 13 AND 19 AND {luhn_sum(d, 1)} % 10 = 0", refilled(m, card)),
    }


def kind_sql(m: str, kinds: tuple[str, ...] = tuple(PATTERNS)) -> str:
    valid = {k: ok for k, (ok, _) in pseudonym_cases(m, "").items()}
    tests = " ".join(f"WHEN {m} RLIKE {quoted('^(?:' + PATTERNS[k] + ')$')} AND {valid[k]} THEN {quoted(k)}" for k in kinds)
    return f"CASE {tests} END"


def inner_sql(m: str) -> str:
    """``m`` as pieces, the first valid phone or card number inside it with its kind: whole groups of digits of ``m``, longest first."""
    start = f"substring({m}, a, 1) RLIKE '[0-9+(]' AND NOT substring(concat(' ', {m}), a, 1) RLIKE '[0-9+(]'"
    end = f"substring({m}, b, 1) RLIKE '[0-9]' AND NOT substring({m}, b + 1, 1) RLIKE '[0-9]'"
    places = f"sequence(1, length({m}))"
    ends = f"reverse(filter({places}, b -> {end}))"
    spans = f"flatten(transform(filter({places}, a -> {start}), a -> transform(filter({ends}, b -> b - a >= 6), b -> named_struct('a', a, 'm', substring({m}, a, b - a + 1)))))"
    judged = f"transform({spans}, c -> named_struct('a', c.a, 'm', c.m, 'kind', {kind_sql('c.m', ('phone', 'card'))}))"
    pieces = (
        f"filter(array(named_struct('m', substring({m}, 1, c.a - 1), 'kind', cast(null AS string)), named_struct('m', c.m, 'kind', c.kind),"
        f" named_struct('m', substring({m}, c.a + length(c.m)), 'kind', cast(null AS string))), p -> p.m <> '')"
    )
    return f"flatten(transform(slice(filter({judged}, c -> c.kind IS NOT NULL), 1, 1), c -> {pieces}))"


def found_sql(t: str) -> str:
    """What the patterns find in ``t``: for each match its pieces with their kinds, null where a piece stays."""
    whole = f"transform(regexp_extract_all({t}, {quoted(ANY)}, 0), m -> named_struct('m', m, 'kind', {kind_sql('m')}))"
    # Under 13 digits there is no room for a card, nor for more than a phone number.
    inside = f"transform(array(CASE WHEN w.kind IS NULL AND length({digits('w.m')}) >= 13 THEN {inner_sql('w.m')} END), i -> if(size(i) > 0, i, array(w)))[0]"
    return f"transform({whole}, w -> {inside})"


def pseudonymised(docs: DataFrame, key: str | DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` rewritten, and ``pii_kinds``: the kind of each value replaced, in order.

    The key is read from a table of one row, ``key``, by a scalar subquery, so plans and event logs only
    name the table. A key given as text is written to the shared folder first; who reads that
    folder can undo the pseudonyms, so a production key belongs in a table of its own.
    """
    table = key if isinstance(key, DataFrame) else stored(docs.sparkSession.createDataFrame([(key,)], "key string"), "key")
    cases = pseudonym_cases("f.m", KEY)
    new = "CASE f.kind " + " ".join(f"WHEN {quoted(k)} THEN {p}" for k, (_, p) in cases.items()) + " ELSE f.m END"
    # The cards of a text, as they are written, and a pattern for just these.
    cards = f"array_distinct(filter(regexp_extract_all(`{text}`, {quoted(CARD_STARTS)}, 1), m -> {pseudonym_cases('m', '')['card'][0]}))"
    exact = f"concat({quoted(BEFORE_CARD + '(?:')}, array_join(__cards, '|'), {quoted(')' + BEHIND_CARD)})"
    # The text between the cards is searched for everything; pieces in turn: text that stays, matches, and the card behind it.
    between = f"if(size(__cards) > 0, split(`{text}`, {exact}, -1), array(`{text}`))"
    taken = f"transform(if(size(__cards) > 0, regexp_extract_all(`{text}`, {exact}, 0), array()), m -> array(named_struct('m', m, 'kind', 'card')))"
    kept = f"transform(split(t, {quoted(ANY)}, -1), s -> array(named_struct('m', s, 'kind', cast(null AS string))))"
    # ``kept`` has one element more than what is found, and ``between`` one more than ``taken``: the missing one is null.
    row = f"flatten(flatten(zip_with({kept}, {found_sql('t')}, (s, w) -> array(s, coalesce(w, array())))))"
    pieces = f"flatten(flatten(zip_with(transform({between}, t -> {row}), {taken}, (r, c) -> array(r, coalesce(c, array())))))"
    # Most texts have neither a digit nor an at sign: one cheap look spares them the search.
    keyed = docs.withColumn(KEY, table.select("key").scalar())
    found = keyed.withColumn("__cards", F.when(F.col(text).rlike("[0-9]{4}"), F.expr(cards)).otherwise(F.expr("array()").cast("array<string>")))
    found = found.withColumn("__found", F.when(F.col(text).rlike("[0-9@]"), F.expr(pieces)))
    rewritten = f"array_join(transform(__found, f -> {new}), '')"
    return (
        found.withColumn(text, F.when(F.expr("size(__found) > 1"), F.expr(rewritten)).otherwise(F.col(text)))
        .withColumn("pii_kinds", F.expr("coalesce(transform(filter(__found, f -> f.kind IS NOT NULL), f -> f.kind), array())").cast("array<string>"))
        .drop("__found", "__cards", KEY)
    )
