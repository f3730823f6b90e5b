from __future__ import annotations

import datetime as dt
import hashlib
import re

from offerlift.llm import pii

DAY0 = dt.date(1900, 1, 1)


def feistel(kind, a, b, m, n, key):
    for r in range(1, 9):
        other = b if r % 2 else a
        text = f"{key}:{kind}:{m}:{n}:{r}:{other}"
        noise = int(hashlib.sha256(text.encode()).hexdigest()[:15], 16)
        a, b = ((a + noise) % m, b) if r % 2 else (a, (b + noise) % n)
    return a, b


def luhn(digits):
    return sum(v - 9 * (v > 9) for i, d in enumerate(reversed(digits)) for v in [int(d) * (1 + i % 2)]) % 10


def day(v):
    for p in ("%Y-%m-%d", "%d.%m.%Y", "%m/%d/%Y", "%d/%m/%Y"):
        try:
            return dt.datetime.strptime(v, p).date(), p
        except ValueError:
            pass
    return None, None


def digits_of(kind, d, key):
    u = len(d) // 2
    a, b = feistel(kind, int(d[:u] or 0), int(d[u:] or 0), 10**u, 10 ** (len(d) - u), key)
    return (f"{a:0{u}d}" if u else "") + f"{b:0{len(d) - u}d}"


def fill(v, new):
    out, new = [], list(new)
    for c in reversed(v):
        out.append(new.pop() if c.isdigit() and new else c)
    return "".join(reversed(out))


def replaced(v, key):
    d = re.sub(r"\D", "", v)
    if "@" in v:
        return "u" + hashlib.sha256(f"{key}:email:{v.lower()}".encode()).hexdigest()[:16] + "@mail.invalid"
    if v.startswith("+"):
        if not 8 <= len(d) <= 15:
            return v
        code = re.match(r"\+(\d{1,3})(?!\d)", v)
        return fill(v, digits_of("phone", d[len(code[1]) if code else 1 :], key))
    if re.fullmatch(pii.IP, v):
        p = v.split(".")
        if any(int(x) > 255 or x != str(int(x)) for x in p):
            return v
        p = list(map(int, p))
        a, b = feistel("ip", p[0] * 256 + p[1], p[2] * 256 + p[3], 65536, 65536, key)
        return f"{a >> 8}.{a & 255}.{b >> 8}.{b & 255}"
    if re.fullmatch(pii.DATE, v):
        when, shape = day(v)
        if when is None or not 1800 <= when.year < 2200:
            return v
        era, at = divmod((when - DAY0).days, 73000)
        a, b = feistel("date", at // 292, at % 292, 250, 292, key)
        return (DAY0 + dt.timedelta(era * 73000 + a * 292 + b)).strftime(shape)
    if re.fullmatch(pii.SSN, v):
        if v[:3] in ("000", "666") or v[0] == "9" or v[4:6] == "00" or v[7:] == "0000":
            return v
        area = int(v[:3])
        a, b = feistel("ssn", area - (2 if area > 666 else 1), (int(v[4:6]) - 1) * 9999 + int(v[7:]) - 1, 898, 99 * 9999, key)
        return f"{a + (2 if a >= 665 else 1):03d}-{b // 9999 + 1:02d}-{b % 9999 + 1:04d}"
    if luhn(d):
        return v
    new = digits_of("card", d[:-1], key)
    return fill(v, new + str((10 - luhn(new + "0")) % 10))


def brute(text, key="offerlift"):
    return None if text is None else re.sub(pii.VALUE, lambda m: replaced(m[0], key), text)


TEXTS = [
    None,
    "",
    "no values, 12 and 3.14 and v1.2.3.4.5",
    "card 4845168114407329 and again 4845168114407329 then 9807915762804490 invalid",
    "4845168114407329 12, 4845 1681 1440 7329; 4845-1681-1440-7329. 378282246310005 3782 822463 10005",
    "call +1 (017) 555-7713 or +49 30 1234567, +4917012345678; +1 22 bad +12345678901234567890",
    "ip 97.51.17.173, 129.38.82.176. 256.1.1.1 01.2.3.4 0.0.0.0 255.255.255.255 1.2.3.4.5",
    "born 1984-02-29 or 29.02.1985 or 31.12.1999, 12/31/1999 31/12/1999 2/3/2001 1700-01-01 2199-12-31",
    "ssn 123-45-6789 000-12-3456 666-12-3456 899-99-9999 001-01-0001 123-00-4567",
    "mail und.34@mail7.example.com, éa.b@c.de x@y a+b%c@d-e.co.uk! UND.34@mail7.example.com",
    "日本4845168114407329é𝒳97.51.17.173𝒳",
]


def test_texts_equal_the_plain_form(spark):
    long_text = " ".join(TEXTS[3:]) + " word" * 50_000
    rows = [(i, t, "f", 7) for i, t in enumerate([*TEXTS, long_text, TEXTS[3]])]
    docs = spark.createDataFrame(rows, "doc_id int, text string, k string, n_card int")
    got = {r.doc_id: r for r in pii.pseudonymise(docs, counts="found").collect()}
    for i, t, k, n in rows:
        assert got[i].text == brute(t)
        assert (got[i].k, got[i].n_card) == (k, n)
    assert tuple(got[3].found) == (2, 0, 0, 0, 0, 0)
    assert got[3].text.split()[1] == got[3].text.split()[4] != "4845168114407329"
    assert luhn(got[3].text.split()[1]) == 0
    assert pii.pseudonymise(docs.limit(0)).count() == 0


def test_networks_are_permutations():
    for kind, m, n in (("date", 250, 292), ("card", 10, 100)):
        made = {feistel(kind, a, b, m, n, "k") for a in range(m) for b in range(n)}
        assert len(made) == m * n


def test_whole_table_equals_the_plain_form(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = dict(pii.pseudonymise(docs).select("doc_id", "text").collect())
    want = {r.doc_id: brute(r.text) for r in docs.collect()}
    assert got == want
    assert sum(t != r.text for r in docs.collect() for t in [got[r.doc_id]]) > 0
