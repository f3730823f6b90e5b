"""Format-preserving pseudonyms for personal numbers, dates and addresses.

What looks like a card number, phone number, internet address, date, US social
security number or e-mail address is validated (check digit, ranges, calendar).
A valid value becomes a pair of numbers in a box of fixed size, the pair goes
through a keyed Feistel network on that box, and the result is written in the
value's own format. The network is a permutation, so different values stay
different and equal values stay equal, in every document, as long as the key is
the same. E-mail names are not numbers; they become a keyed digest.

Everything is SQL expressions; one pass over the rows, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlift.llm.texts import keeps_names

ROUNDS = 8
KEY = "offerlift"
KINDS = ("card", "phone", "ip", "date", "ssn", "email")
#: Days of one era, within which dates are permuted: 250 times 292 from 1900-01-01.
_ERA, _ERA_SIDE = 73_000, 292

# Patterns of the kinds.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IP = r"\d{1,3}(?:\.\d{1,3}){3}"
DATE = r"\d{4}-\d{2}-\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4}"
SSN = r"\d{3}-\d{2}-\d{4}"
CARD = r"\d{13,19}|\d{4} \d{4} \d{4} \d{4}|\d{4}-\d{4}-\d{4}-\d{4}|\d{4}[ -]\d{6}[ -]\d{5}"
PHONE = r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}"
_END = r"(?![0-9A-Za-z]|[.-][0-9])"
VALUE = rf"{EMAIL}|(?<![0-9A-Za-z.+-])(?:{IP}|{DATE}|{SSN}|{CARD}){_END}|(?<![0-9A-Za-z+]){PHONE}{_END}"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def _number(text: str) -> str:
    return f"coalesce(cast(nullif({text}, '') as bigint), 0L)"


def _luhn_sum(digits: str, doubled: int) -> str:
    """Sum of check-digit weights; ``doubled`` tells which places count twice, from the right."""
    digit = f"cast(substring({digits}, length({digits}) - i, 1) as int)"
    twice = f"({digit} * 2 - if({digit} > 4, 9, 0))"
    return (
        f"aggregate(sequence(0, length({digits}) - 1), 0,"
        f" (t, i) -> t + if(i % 2 = {doubled}, {twice}, {digit}))"
    )


def _day(value: str) -> str:
    return (
        f"coalesce(try_to_date({value}, 'yyyy-MM-dd'), try_to_date({value}, 'd.M.yyyy'),"
        f" try_to_date({value}, 'M/d/yyyy'), try_to_date({value}, 'd/M/yyyy'))"
    )


def _since(value: str) -> str:
    return f"datediff({_day(value)}, date'1900-01-01')"


def _kind(v: str) -> str:
    parts = f"split({v}, '[.]')"
    octet = "p -> cast(p as int) < 256 and (p = '0' or p not like '0%')"
    digits = _digits(v)
    ssn = (
        f"substring({v}, 1, 3) not in ('000', '666') and substring({v}, 1, 1) <> '9'"
        f" and substring({v}, 5, 2) <> '00' and substring({v}, 8, 4) <> '0000'"
    )
    return f"""case
      when {v} like '%@%' then 'email'
      when {v} like '+%' then if(length({digits}) between 8 and 15, 'phone', '')
      when {v} rlike {_quoted(f'^(?:{IP})$')} then if(forall({parts}, {octet}), 'ip', '')
      when {v} rlike {_quoted(f'^(?:{DATE})$')}
        then if(year({_day(v)}) between 1800 and 2199, 'date', '')
      when {v} rlike {_quoted(f'^(?:{SSN})$')} then if({ssn}, 'ssn', '')
      else if({_luhn_sum(digits, 1)} % 10 = 0, 'card', '') end"""


def _payload(k: str, v: str) -> str:
    """Digits that are permuted as digits: without check digit or country code."""
    digits = _digits(v)
    code = rf"greatest(1, length(regexp_extract({v}, '^\\+([0-9]{{1,3}})(?![0-9])', 1)))"
    return f"""case {k} when 'card' then left({digits}, length({digits}) - 1)
      when 'phone' then substring({digits}, {code} + 1) else '' end"""


def _box(k: str, v: str, d: str) -> str:
    """A value as a pair of numbers and the sides of the box they lie in."""

    def pair(*numbers) -> str:
        fields = zip("abmn", numbers, strict=True)
        return f"named_struct({', '.join(f"'{f}', cast({x} as bigint)" for f, x in fields)})"

    octets = [f"cast(split({v}, '[.]')[{i}] as int)" for i in range(4)]
    side = f"cast(floor(length({d}) / 2) as int)"
    area = f"cast(left({v}, 3) as int)"
    rest = f"(cast(substring({v}, 5, 2) as int) - 1) * 9999 + cast(substring({v}, 8, 4) as int) - 1"
    in_era = f"pmod({_since(v)}, {_ERA})"
    halves = pair(
        _number(f"left({d}, {side})"),
        _number(f"substring({d}, {side} + 1)"),
        f"pow(10, {side})",
        f"pow(10, length({d}) - {side})",
    )
    ip = pair(f"{octets[0]} * 256 + {octets[1]}", f"{octets[2]} * 256 + {octets[3]}", 65536, 65536)
    date = pair(
        f"floor({in_era} / {_ERA_SIDE})", f"{in_era} % {_ERA_SIDE}", _ERA // _ERA_SIDE, _ERA_SIDE
    )
    ssn = pair(f"{area} - if({area} > 666, 2, 1)", rest, 898, 99 * 9999)
    return f"""case when {k} = 'ip' then {ip} when {k} = 'date' then {date}
      when {k} = 'ssn' then {ssn} when {k} in ('card', 'phone') then {halves} end"""


def _permuted(k: str, box: str, key: str) -> str:
    """The pair after the Feistel rounds; odd rounds change the first number, even ones the second."""

    def noise(other: str) -> str:
        text = f"concat_ws(':', {_quoted(key)}, {k}, {box}.m, {box}.n, r, {other})"
        return f"cast(conv(left(sha2({text}, 256), 15), 16, 10) as bigint)"

    return (
        f"aggregate(sequence(1, {ROUNDS}), named_struct('a', {box}.a, 'b', {box}.b), (x, r) ->"
        f" named_struct('a', if(r % 2 = 1, pmod(x.a + {noise('x.b')}, {box}.m), x.a),"
        f" 'b', if(r % 2 = 0, pmod(x.b + {noise('x.a')}, {box}.n), x.b)))"
    )


def _filled(template: str, digits: str) -> str:
    """``template`` with its digits replaced, from the right, by all of ``digits``."""
    seen = f"length({_digits(f'substring({template}, i + 1)')})"
    place = f"length({digits}) - {seen}"
    char = f"substring({template}, i, 1)"
    return (
        f"array_join(transform(sequence(1, length({template})), i ->"
        f" if({char} between '0' and '9' and {place} > 0, substring({digits}, {place}, 1),"
        f" {char})), '')"
    )


def _new_digits(d: str, ab: str) -> str:
    side = f"cast(floor(length({d}) / 2) as int)"
    return (
        f"concat(if({side} = 0, '', lpad(cast({ab}.a as string), {side}, '0')),"
        f" lpad(cast({ab}.b as string), length({d}) - {side}, '0'))"
    )


def _written(k: str, v: str, ab: str, new: str, key: str) -> str:
    day = (
        f"date_add(date'1900-01-01', cast(floor({_since(v)} / {_ERA}) * {_ERA}"
        f" + {ab}.a * {_ERA_SIDE} + {ab}.b as int))"
    )
    slashed = f"if(try_to_date({v}, 'M/d/yyyy') is null, 'dd/MM/yyyy', 'MM/dd/yyyy')"
    area = f"{ab}.a + if({ab}.a >= 665, 2, 1)"

    def padded(number: str, width: int) -> str:
        return f"lpad(cast({number} as string), {width}, '0')"

    return f"""case {k}
      when 'email' then concat(
        'u', left(sha2(concat_ws(':', {_quoted(key)}, {k}, lower({v})), 256), 16), '@mail.invalid')
      when 'ip' then concat_ws('.', cast(floor({ab}.a / 256) as string),
        cast({ab}.a % 256 as string), cast(floor({ab}.b / 256) as string),
        cast({ab}.b % 256 as string))
      when 'date' then case when {v} like '%-%' then date_format({day}, 'yyyy-MM-dd')
        when {v} like '%.%' then date_format({day}, 'dd.MM.yyyy')
        else if({slashed} = 'dd/MM/yyyy', date_format({day}, 'dd/MM/yyyy'),
          date_format({day}, 'MM/dd/yyyy')) end
      when 'ssn' then concat_ws('-', {padded(area, 3)}, {padded(f'floor({ab}.b / 9999) + 1', 2)},
        {padded(f'{ab}.b % 9999 + 1', 4)})
      when 'card' then {_filled(v, new)}
      when 'phone' then {_filled(v, new)}
      else {v} end"""


def _found(text: str, key: str) -> str:
    """SQL for an array of ``k, w``: kind and new form of all that looks like a value."""
    check = f"cast((10 - {_luhn_sum('s.n', 0)} % 10) % 10 as string)"
    steps = [
        f"named_struct('v', s, 'k', {_kind('s')})",
        f"named_struct('v', s.v, 'k', s.k, 'd', {_payload('s.k', 's.v')})",
        f"named_struct('v', s.v, 'k', s.k, 'd', s.d, 'x', {_box('s.k', 's.v', 's.d')})",
        f"named_struct('v', s.v, 'k', s.k, 'd', s.d, 'y', {_permuted('s.k', 's.x', key)})",
        f"named_struct('v', s.v, 'k', s.k, 'y', s.y, 'n', {_new_digits('s.d', 's.y')})",
        f"named_struct('v', s.v, 'k', s.k, 'y', s.y,"
        f" 'n', if(s.k = 'card', concat(s.n, {check}), s.n))",
        f"named_struct('k', s.k, 'w', {_written('s.k', 's.v', 's.y', 's.n', key)})",
    ]
    found = f"regexp_extract_all({text}, {_quoted(VALUE)}, 0)"
    for step in steps:
        found = f"transform({found}, s -> {step})"
    return found


@keeps_names
def pseudonymise(
    docs: DataFrame, text: str = "text", key: str = KEY, counts: str | None = None
) -> DataFrame:
    """``docs`` with every valid value in ``text`` replaced; all other columns as they are.

    With ``counts``, a column of that name has a struct of the number of
    replaced values of each kind. Invalid look-alikes stay. A null text stays
    null, an empty one empty; repeated rows and ties need no care, and an empty
    table gives an empty one.
    """
    column = f"`{text}`"
    # Most texts have no digit and no sign of an address; most of the rest has no value.
    likely = f"{column} rlike '[0-9@]' and {column} rlike {_quoted(VALUE)}"
    none = "array()"
    found = f"case when {likely} then {_found(column, key)} else cast({none} as array<struct<k:string,w:string>>) end"
    marked = docs.withColumn("__found", F.expr(found))
    parts = f"split({column}, {_quoted(VALUE)}, -1)"
    new = f"array_join(zip_with({parts}, __found, (p, f) -> concat(p, coalesce(f.w, ''))), '')"
    new = F.expr(f"case when size(__found) > 0 then {new} else {column} end")
    kinds = [f"'{k}', size(filter(__found, f -> f.k = '{k}'))" for k in KINDS]
    made = [new.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c != counts]
    if counts is not None:
        made.append(F.expr(f"named_struct({', '.join(kinds)})").alias(counts))
    return marked.select(*made)
