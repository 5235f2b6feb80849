"""Personal data replaced by format-preserving Feistel pseudonyms, in SQL expressions only.

Found and validated: e-mail addresses; IPv4 addresses (octets to 255); dates from 1900 to 2099
(2001-02-03, 3/2/2001, 3.2.2001, the day first where both readings are dates); US social security
numbers; IBANs (mod 97); payment cards of 13 to 19 digits (Luhn); telephone numbers. Candidates
that fail their check are left alone. The leftmost match wins, in the order of PATTERNS.

A keyed Feistel network permutes the digits of a value within its format: a card keeps its length
and gets a right check digit, an IBAN keeps its country and letters and gets right check digits,
an address stays an address, a date a date in the same notation, a social security number stays a
possible one (by walking the cycle), a telephone number keeps its country code and signs. The same
value always gets the same pseudonym, in all documents and notations, and different values get
different ones. E-mail addresses are neither numbers nor dates and get a keyed hash as user name.

Nulls stay null with counts 0, empty texts stay empty, empty tables give empty results, repeated
rows are each handled, other columns are carried on. The key is part of the plan: keep plans and
event logs of real runs private.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "date", "ssn", "iban", "card", "phone")

PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
    "date": r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}[/.]\d{1,2}[/.]\d{4})(?![\d/-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<!\d)(?:\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?!\d)",
    "phone": r"(?<![\d+])(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5})(?!\d)",
}
EVERY = "|".join(f"({PATTERNS[k]})" for k in KINDS)

_names = count()


def _let(value: str, body) -> str:
    """body(name of value), with value computed once."""
    name = f"v{next(_names)}"
    return f"transform(array({value}), {name} -> {body(name)})[0]"


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _digest(key: str, *parts: str) -> str:
    """A keyed 60-bit number."""
    return f"cast(conv(substring(sha2(concat_ws('|', {key}, {', '.join(parts)}, {key}), 256), 1, 15), 16, 10) as bigint)"


def permuted_digits(x: str, key: str, tag: str) -> str:
    """x: digits, 2 to 36. Ten rounds over unequal halves, as in FF1."""
    step = f"cast(pmod(cast(s.a as bigint) + {_digest(key, _quoted(tag), 'i', 'length(s.a) + length(s.b)', 's.b')}, cast(power(10, length(s.a)) as bigint)) as string)"
    return _let(x, lambda v: f"aggregate(sequence(0, 9), named_struct('a', substring({v}, 1, cast(length({v}) / 2 as int)), 'b', substring({v}, cast(length({v}) / 2 as int) + 1)), (s, i) -> named_struct('a', s.b, 'b', lpad({step}, length(s.a), '0')), s -> concat(s.a, s.b))")


def permuted_number(x: str, key: str, tag: str, high: int, low: int) -> str:
    """x: a number below high * low. Ten rounds that add modulo high and low in turns."""
    step = f"pmod(s.a + {_digest(key, _quoted(tag), 'i', 's.b')}, if(i % 2 = 0, {high}L, {low}L))"
    return _let(x, lambda v: f"aggregate(sequence(0, 9), named_struct('a', cast({v} div {low} as bigint), 'b', cast({v} % {low} as bigint)), (s, i) -> named_struct('a', s.b, 'b', {step}), s -> s.a * {low}L + s.b)")


def _walked(first: str, again, fits) -> str:
    """Permutes on until the value fits; 32 steps fail less often than once in 10**29."""
    n = next(_names)
    return f"aggregate(sequence(1, 32), {first}, (w{n}, j{n}) -> if({fits(f'w{n}')}, w{n}, {again(f'w{n}')}))"


def digits_of(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def _put_back(m: str, digits: str) -> str:
    """m with its digits replaced in order."""
    return _let(digits, lambda d: f"aggregate(split({m}, ''), named_struct('t', '', 'k', 1), (s, c) -> named_struct('t', concat(s.t, if(c between '0' and '9' and c <> '', substring({d}, s.k, 1), c)), 'k', s.k + if(c between '0' and '9' and c <> '', 1, 0)), s -> s.t)")


def _luhn_sum(x: str, doubled: int) -> str:
    """Digits from the right; those whose place, from 1, has this parity count twice."""
    d = f"cast(substring({x}, length({x}) - i + 1, 1) as int)"
    return f"aggregate(sequence(1, length({x})), 0, (t, i) -> t + if(i % 2 = {doubled}, 2 * {d} - if({d} > 4, 9, 0), {d}))"


def _mod97(x: str) -> str:
    """Of letters and digits, letters as 10 to 35."""
    return f"aggregate(split({x}, ''), 0, (t, c) -> if(c = '', t, if(c between '0' and '9', (t * 10 + cast(c as int)) % 97, (t * 100 + ascii(c) - 55) % 97)))"


def _ssn_fits(x: str) -> str:
    return f"(substring({x}, 1, 3) not in ('000', '666') and substring({x}, 1, 1) <> '9' and substring({x}, 4, 2) <> '00' and substring({x}, 6, 4) <> '0000')"


_ORIGIN, _DAYS = "date'1900-01-01'", 73049


def _date(m: str) -> str:
    """(day, format) of m, or nulls. Days and months of one digit are kept as such by the format."""
    sep = f"if(instr({m}, '/') > 0, '/', '.')"

    def read(a: int, b: int) -> str:
        y, mo, d = f"cast(split({m}, '[/.]')[2] as int)", f"cast(split({m}, '[/.]')[{b}] as int)", f"cast(split({m}, '[/.]')[{a}] as int)"
        return f"try_to_date(concat_ws('-', lpad(cast({y} as string), 4, '0'), lpad(cast({mo} as string), 2, '0'), lpad(cast({d} as string), 2, '0')), 'yyyy-MM-dd')"

    iso = f"named_struct('d', try_to_date({m}, 'yyyy-MM-dd'), 'f', 'yyyy-MM-dd')"
    day_first = f"named_struct('d', {read(0, 1)}, 'f', concat('dd', {sep}, 'MM', {sep}, 'yyyy'))"
    month_first = f"named_struct('d', {read(1, 0)}, 'f', concat('MM', {sep}, 'dd', {sep}, 'yyyy'))"
    return f"case when instr({m}, '-') > 0 then {iso} when {read(0, 1)} is not null then {day_first} else {month_first} end"


def _kind(m: str) -> str:
    whole = {k: rf"\A(?:{PATTERNS[k]})\z" for k in KINDS}
    cases = {
        "email": f"instr({m}, '@') > 0",
        "ip": f"{m} rlike {_quoted(whole['ip'])}",
        "date": f"{m} rlike {_quoted(whole['date'])}",
        "ssn": f"{m} rlike {_quoted(whole['ssn'])}",
        "iban": f"{m} rlike '^[A-Z]'",
        "card": f"{m} rlike {_quoted(whole['card'])}",
    }
    valid = {
        "ip": f"forall(split({m}, '[.]'), o -> cast(o as int) <= 255)",
        "date": _let(_date(m), lambda d: f"coalesce({d}.d between {_ORIGIN} and date'2099-12-31', false)"),
        "ssn": _ssn_fits(digits_of(m)),
        "iban": f"{_mod97(f'''concat(substring(replace({m}, ' ', ''), 5), substring(replace({m}, ' ', ''), 1, 4))''')} = 1",
        "card": _let(digits_of(m), lambda d: f"{_luhn_sum(d, 0)} % 10 = 0"),
    }
    branches = " ".join(f"when {cases[k]} then " + (f"if({valid[k]}, '{k}', null)" if k in valid else f"'{k}'") for k in KINDS[:-1])
    return f"case {branches} else 'phone' end"


def _pseudonym(m: str, kind: str, key: str) -> str:
    def card(d: str) -> str:
        payload = permuted_digits(f"substring({d}, 1, length({d}) - 1)", key, "card")
        return _put_back(m, _let(payload, lambda p: f"concat({p}, cast((10 - {_luhn_sum(p, 1)} % 10) % 10 as string))"))

    def iban(x: str) -> str:
        body = f"substring({x}, 5)"
        changed = f"if(length({digits_of(body)}) < 2, {body}, {_put_back(body, permuted_digits(digits_of(body), key, 'iban'))})"
        return _let(changed, lambda b: f"concat(substring({x}, 1, 2), lpad(cast(98 - {_mod97(f'''concat({b}, substring({x}, 1, 2), '00')''')} as string), 2, '0'), {b})")

    def spaced(x: str) -> str:
        return f"aggregate(split({m}, ''), named_struct('t', '', 'k', 1), (s, c) -> named_struct('t', concat(s.t, if(c = ' ', c, if(c = '', '', substring({x}, s.k, 1)))), 'k', s.k + if(c in (' ', ''), 0, 1)), s -> s.t)"

    def phone(d: str) -> str:
        code = f"length(regexp_extract({m}, '^\\\\+([0-9]{{1,3}}?)(?=[ .(-]|[0-9]{{6,12}}$)', 1))"
        return _put_back(m, f"concat(substring({d}, 1, {code}), {permuted_digits(f'substring({d}, {code} + 1)', key, 'phone')})")

    day = lambda x: permuted_number(x, key, "date", 271, 270)
    octets = f"aggregate(split({m}, '[.]'), 0L, (t, o) -> t * 256L + cast(o as int))"
    as_ip = lambda x: f"concat_ws('.', {x} div 16777216, {x} div 65536 % 256, {x} div 256 % 256, {x} % 256)"
    ssn = _walked(permuted_digits(digits_of(m), key, "ssn"), lambda w: permuted_digits(w, key, "ssn"), _ssn_fits)
    date = _let(_date(m), lambda d: f"date_format(date_add({_ORIGIN}, cast({_walked(day(f'cast(datediff({d}.d, {_ORIGIN}) as bigint)'), day, lambda w: f'{w} < {_DAYS}')} as int)), {d}.f)")
    return f"""case {kind}
      when 'email' then concat('user-', substring(sha2(concat_ws('|', {key}, 'email', lower({m}), {key}), 256), 1, 16), '@masked.invalid')
      when 'ip' then {_let(permuted_number(octets, key, "ip", 65536, 65536), as_ip)}
      when 'date' then {date}
      when 'ssn' then {_put_back(m, ssn)}
      when 'iban' then {_let(_let(f"replace({m}, ' ', '')", iban), spaced)}
      when 'card' then {_let(digits_of(m), card)}
      when 'phone' then {_let(digits_of(m), phone)}
      else {m} end"""


def pseudonymize(docs: DataFrame, *, key: str, text: str = "text", prefix: str = "n_") -> DataFrame:
    """docs with pseudonyms in the text column, and a count of each kind in n_<kind> (bigint).

    key: whoever has it can tell which pseudonym a value gets, so it is never a default.
    A column of docs that has the name of a count is replaced.
    """
    secret, pattern = _quoted(key), _quoted(EVERY)
    source = f"`{text}`"
    found = docs.withColumn("__found", F.expr(f"case when {source} rlike '[0-9@]' then transform(regexp_extract_all({source}, {pattern}, 0), m -> named_struct('m', m, 'k', {_kind('m')})) end"))
    pseudonyms = F.expr(f"transform(__found, f -> {_pseudonym('f.m', 'f.k', secret)})")
    between = F.expr(f"split({source}, {pattern}, -1)")
    joined = F.array_join(F.zip_with(between, pseudonyms, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    counts = {f"{prefix}{k}": F.expr(f"cast(coalesce(size(filter(__found, f -> f.k = '{k}')), 0) as bigint)") for k in KINDS}
    none = F.expr("coalesce(not exists(__found, f -> f.k is not null), true)")
    return found.withColumns(counts | {text: F.when(none, F.col(source)).otherwise(joined)}).drop("__found")
