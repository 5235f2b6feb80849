"""Pseudonyms, secrets and mixing against brute force."""

import datetime
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from folioforge.llm.mixing import mixture, rake, sample, topic_of, weights, words_of
from folioforge.llm.pii import KINDS, permuted_digits, permuted_number, pseudonymize
from folioforge.llm.secrets import HEX, SCOPE, WEAK_ENDPOINT, WEAK_ID, WEAK_SECRET, find_secrets

ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    names = ("assign", "access", "hex")
    listed = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(spans))
    return tuple(sum(k == n for _, k, _ in spans) for n in range(3)) + (hashlib.sha256(listed.encode()).hexdigest(),)


def test_secrets_match_brute_force(spark):
    rng = random.Random(6)
    parts = ["token", "API_KEY", "apikey", "secret", "Password", ":", "=", " = ", '"', "'", " ", "\n", "abcdefgh", "AKIA", "AKIAABCDEFGH1234", "0123456789abcdef" * 2, "f" * 31, "é🎉", "x", "user: bob", "https://h.example.com/x", "Zx9" * 8]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(400)] + [None, "", "x " * 40000 + 'token="' + "a" * 40 + '"']
    got = find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r["doc_id"]] or ""
        assert (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) == base(text), text
        kinds = [s.split(":")[0] for s in r["spans"].split(",") if s]
        assert kinds.count("assign") == r["n_assign"] and len(kinds) == r["n_assign"] + r["n_access"] + r["n_hex"] + r["n_linked"]


def test_weak_parts_need_each_other(spark):
    weak = "Zx9Zx9Zx9Zx9Zx9Zx9Zx9Q"
    texts = [f"login: bob and {weak}", weak, "login: bob", f"login: bob {'y ' * 300} {weak}", f"{weak} at https://db.example.com"]
    got = {r["doc_id"]: r["spans"] for r in find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [bool(got[k]) for k in range(5)] == [True, False, False, False, True]
    assert find_secrets(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def luhn(s):
    return sum(d * 2 - 9 * (d > 4) if k % 2 else d for k, d in enumerate(map(int, reversed(s)))) % 10 == 0


def test_permutations_are_one_to_one(spark):
    rows = spark.range(1000).withColumn("d", F.lpad(F.col("id").cast("string"), 3, "0"))
    got = rows.select(F.expr(permuted_digits("d", "'k'", "t")).alias("x"), F.expr(permuted_number("id", "'k'", "t", 40, 25)).alias("y")).collect()
    assert {r["x"] for r in got} == {f"{i:03d}" for i in range(1000)} and {r["y"] for r in got} == set(range(1000))


def test_pseudonyms(spark):
    rows = [(1, "a.b@c.example.com, +1 (017) 555-7713; 4111 1111 1111 1111 or 4111111111111111 at 97.51.17.173 on 2001-02-03, 123-45-6789 GB82 WEST 1234 5698 7654 32"), (2, "4111111111111111"), (3, "4111111111111112 999.1.1.1 2001-02-30 000-12-3456 Version 2.0."), (4, None), (5, ""), (2, "4111111111111111"), (6, "9807915762804490 4104321470856409")]
    out = pseudonymize(spark.createDataFrame(rows, "doc_id long, text string"), key="folioforge").collect()
    by = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows) and by[4]["text"] is None and by[5]["text"] == "" and by[3]["text"] == rows[2][1]
    cards = re.findall(r"\b\d{4} \d{4} \d{4} \d{4}|\b\d{16}", by[1]["text"])
    assert len({c.replace(" ", "") for c in cards} | {by[2]["text"]}) == 1 and luhn(by[2]["text"]) and by[2]["text"] != rows[1][1]
    assert tuple(by[1][f"n_{k}"] for k in ("email", "ip", "date", "ssn", "iban", "card", "phone")) == (1, 1, 1, 1, 1, 2, 1)
    for old in ("a.b@c", "555-7713", "97.51.17.173", "2001-02-03", "123-45-6789", "5698 7654"):
        assert old not in by[1]["text"]
    iban = re.search(r"GB\d\d WEST [\d ]+\d", by[1]["text"])[0].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert sum(luhn(x) for x in by[6]["text"].split()) == sum(luhn(x) for x in rows[6][1].split())


def test_raking_meets_the_targets(spark):
    cells = spark.createDataFrame([("a", "x", "p", 900), ("a", "y", "q", 50), ("b", "x", "q", 30), ("b", "y", "p", 20), (None, "x", "p", 10)], "source string, lang string, topic string, words long")
    got = rake(cells, alpha=0.7, rounds=20).collect()
    total = sum(r["words"] for r in got)
    for dim in ("source", "lang", "topic"):
        have, want = {}, {}
        for r in got:
            have[r[dim]] = have.get(r[dim], 0) + r["raked"]
            want[r[dim]] = want.get(r[dim], 0) + r["words"]
        norm = sum(v**0.7 for v in want.values())
        for k in have:
            assert have[k] / total == pytest.approx(want[k] ** 0.7 / norm, rel=0.02)


def test_mixing_edges(spark):
    rows = [(k, "w " * (k % 60 + 1), f"s{k % 3}", "en" if k % 4 else None, "clash") for k in range(300)] + [(None, "no id", "s0", "en", "c"), (901, None, None, None, "c"), (902, "", "s9", "de", "c"), (5, "w w", "s2", "en", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic string")
    got = mixture(docs).collect()
    assert len(got) == len(rows) and all(0 <= r["__probability"] <= 1 for r in got)
    expected = sum(r["__probability"] * r["__words"] for r in got)
    assert expected == pytest.approx(0.8 * sum(r["__words"] for r in got), rel=1e-6)
    kept = sample(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["__sampled"] for r in got)
    assert weights(docs.limit(0)).count() == 0


def test_raking_in_many_tasks_equals_one(spark):
    """Past SMALL_CELLS the sums are grouped and joined; the rows stay the same."""
    rng = random.Random(12)
    rows = [(k, "w " * rng.randint(0, 90), rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.choice(["x", "y", None]), "c") for k in range(400)] + [(900, "long " * 60000, "a", "x", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, words string")
    small, large = ({r["doc_id"]: r for r in weights(docs, rounds=4, small_cells=n).collect()} for n in (100_000, 0))
    assert small.keys() == large.keys() and len(small) == len(rows)
    for k, r in small.items():
        assert (r["source"], r["lang"], r["topic"], r["n_words"], r["sampled"]) == tuple(large[k][c] for c in ("source", "lang", "topic", "n_words", "sampled"))
        assert r["weight"] == pytest.approx(large[k]["weight"], abs=2e-6) and r["probability"] == pytest.approx(large[k]["probability"], abs=2e-6)


def test_unreachable_targets_are_reported(spark):
    cells = spark.createDataFrame([("a", "x", "p", 50), ("b", "y", "p", 50)], "source string, lang string, topic string, words long")
    targets = {"source": spark.createDataFrame([("a", 9.0), ("b", 1.0)], "value string, weight double"), "lang": spark.createDataFrame([("x", 1.0), ("y", 9.0)], "value string, weight double")}
    with pytest.warns(UserWarning, match="from its target"):
        rake(cells, targets=targets)


def test_counts_of_texts(spark):
    rng = random.Random(13)
    parts = ["a", "B", "|", "*#", "$", " ", "\t", "\n", "\x0b", "\x0c", "\r", "\xa0", "é", "AB", "日本", "  "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(500)] + [None, "", " ", "|" * 3000, "W " * 3000]
    got = spark.createDataFrame(list(enumerate(texts)), "i long, text string").withColumn("n", words_of("text")).withColumn("topic", topic_of("text", F.col("n"))).collect()
    for r in got:
        t = texts[r["i"]] or ""
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t))
        topic = "table" if t.count("|") * 5 > n else "marked" if sum(t.count(c) for c in "*#$%&") > n else "shouted" if len(re.findall("[A-Z]", t)) * 2 > len(t) else "note" if n < 50 else "long" if n >= 2000 else "article"
        assert (r["n"], r["topic"]) == (n, topic), t


def linked(text):
    """All spans: the base ones, and weak ones with a complementary part whose start is at most SCOPE away."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(HEX, text)]
    weak = [(m.start(), 3, m.end()) for m in re.finditer(WEAK_ID, text, re.A)] + [(m.start(), 4, m.end()) for m in re.finditer(WEAK_ENDPOINT, text, re.A)]
    weak += [(m.start(), 5, m.end()) for m in re.finditer(WEAK_SECRET, text, re.A) if re.search("[0-9]", m[0]) and re.search("[a-z]", m[0]) and re.search("[A-Z]", m[0])]
    weak = [w for w in weak if not any(b[0] <= w[0] and w[2] <= b[2] for b in spans)]
    secret = {0: True, 2: True, 5: True}
    near = [w for w in weak if any(abs(w[0] - o[0]) <= SCOPE and secret.get(o[1], False) != secret.get(w[1], False) for o in spans + weak)]
    names = ("assign", "access", "hex", "id", "endpoint", "secret")
    return ",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(spans + near))


def test_linked_spans_match_brute_force(spark):
    rng = random.Random(16)
    parts = ["token=abcdefgh1", "AKIAABCDEFGH1234", "0123456789abcdef" * 2, "é🎉", "user: bob", "Login=al", "client_id: x_y", "https://h.example.com/x?q=1", "http://a.b", "Zx9" * 8, "Zx9-_/" * 5 + "==", " ", "\n", "word " * 20, "word " * 90, "'", ","]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(400)]
    texts += [("https://host.example.com/a " * 6000) + "Zx9" * 8, "token=abcdefgh1 " * 7000, None, ""]
    rows = [(i, t, "clash", 5) for i, t in enumerate(texts)] + [(0, texts[0], "again", 5), (None, texts[1], "no id", 5)]
    got = find_secrets(spark.createDataFrame(rows, "doc_id long, text string, spans string, row int")).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["spans"])
    assert by.pop(None) == {linked(texts[1])}
    for i, spans in by.items():
        assert spans == {linked(texts[i] or "")}, texts[i]
    assert sum(any(k in next(iter(by[i])) for k in ("id:", "endpoint:", "secret:")) for i in range(400)) > 100


def keyed(key, *parts):
    return int(hashlib.sha256("|".join([key, *map(str, parts), key]).encode()).hexdigest()[:15], 16)


def feistel_digits(x, key, tag):
    a, b = x[: len(x) // 2], x[len(x) // 2 :]
    for i in range(10):
        a, b = b, str((int(a) + keyed(key, tag, i, len(x), b)) % 10 ** len(a)).zfill(len(a))
    return a + b


def feistel_number(x, key, tag, high, low):
    a, b = divmod(x, low)
    for i in range(10):
        a, b = b, (a + keyed(key, tag, i, b)) % (low if i % 2 else high)
    return a * low + b


def put_back(value, digits):
    rest = iter(digits)
    return "".join(next(rest) if c in "0123456789" else c for c in value)


def plain_pseudonym(kind, value, key):
    """The same pseudonyms without Spark."""
    digits = re.sub("[^0-9]", "", value)
    if kind == "email":
        return "user-" + hashlib.sha256("|".join([key, "email", value.lower(), key]).encode()).hexdigest()[:16] + "@masked.invalid"
    if kind == "ip":
        n = feistel_number(int.from_bytes(map(int, value.split("."))), key, "ip", 65536, 65536)
        return ".".join(map(str, n.to_bytes(4)))
    if kind == "date":
        form = "%Y-%m-%d" if "-" in value else value[-5] .join(["%d", "%m", "%Y"])
        try:
            day = datetime.datetime.strptime(value, form)
        except ValueError:
            form = value[-5].join(["%m", "%d", "%Y"])
            day = datetime.datetime.strptime(value, form)
        origin, n = datetime.datetime(1900, 1, 1), None
        while n is None or n >= 73049:
            n = feistel_number((day - origin).days if n is None else n, key, "date", 271, 270)
        return (origin + datetime.timedelta(n)).strftime(form)
    if kind == "ssn":
        fits, d = False, digits
        while not fits:
            d = feistel_digits(d, key, "ssn")
            fits = d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
        return put_back(value, d)
    if kind == "card":
        payload = feistel_digits(digits[:-1], key, "card")
        return put_back(value, payload + next(c for c in "0123456789" if luhn(payload + c)))
    if kind == "phone":
        code = re.match(r"\+([0-9]{1,3}?)(?=[ .(-]|[0-9]{6,12}$)", value)
        k = len(code[1]) if code else 0
        return put_back(value, digits[:k] + feistel_digits(digits[k:], key, "phone"))
    plain = value.replace(" ", "")
    body = put_back(plain[4:], feistel_digits(re.sub("[^0-9]", "", plain[4:]), key, "iban"))
    check = 98 - int("".join(str(int(c, 36)) for c in body + plain[:2] + "00")) % 97
    rest = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(rest) for c in value)


def test_pseudonyms_match_plain_python(spark):
    rng = random.Random(17)

    def digits(n):
        return "".join(rng.choices("0123456789", k=n))

    def made(kind):
        if kind == "email":
            return f"{rng.choice(['a.b', 'X', 'jo-e+1'])}@{rng.choice(['c', 'd.ex'])}.{rng.choice(['com', 'Org'])}"
        if kind == "ip":
            return ".".join(str(rng.randrange(256)) for _ in range(4))
        if kind == "date":
            day = datetime.date(1900, 1, 1) + datetime.timedelta(rng.randrange(73049))
            return day.strftime(rng.choice(["%Y-%m-%d", "%d/%m/%Y", "%d.%m.%Y"])) if rng.random() < 0.8 else f"{day.month:02d}/{rng.randint(13, 28)}/{day.year}"
        if kind == "ssn":
            return f"{rng.randint(100, 665)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"
        if kind == "card":
            n = digits(rng.choice([12, 15, 18]))
            whole = n + next(c for c in "0123456789" if luhn(n + c))
            return f"{whole[:4]} {whole[4:8]} {whole[8:12]} {whole[12:]}" if len(whole) == 16 and rng.random() < 0.5 else whole
        if kind == "phone":
            return rng.choice([f"+{rng.randint(1, 9)} ({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}", f"+49 {digits(3)} {digits(4)}"])
        body = rng.choice(["WEST", "A1B2"]) + digits(14)
        check = 98 - int("".join(str(int(c, 36)) for c in body + "GB" + "00")) % 97
        return " ".join(re.findall(".{1,4}", f"GB{check:02d}{body}")) if rng.random() < 0.5 else f"GB{check:02d}{body}"

    rows, want = [], []
    for k in range(120):
        kinds = [rng.choice(KINDS) for _ in range(rng.randint(0, 5))] + [KINDS[k % len(KINDS)]]
        values = [made(kind) for kind in kinds]
        rows.append((k, " and ; ".join(values) + " end", "n", 7))
        want.append((" and ; ".join(plain_pseudonym(*p, "other key") for p in zip(kinds, values, strict=True)) + " end", tuple(kinds.count(x) for x in KINDS)))
    rows.append((120, "word " * 60000 + "4111111111111111", "n", 7))
    want.append(("word " * 60000 + plain_pseudonym("card", "4111111111111111", "other key"), (0, 0, 0, 0, 0, 1, 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_email string, __row int")
    out = pseudonymize(docs, key="other key")
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.columns == [*docs.columns, *[f"n_{k}" for k in KINDS if k != "email"]] and len(got) == len(rows)
    for k, (text, counts) in enumerate(want):
        assert (got[k]["text"], tuple(got[k][f"n_{x}"] for x in KINDS)) == (text, counts), rows[k][1][:300]
    assert pseudonymize(docs.limit(0), key="k").count() == 0


def test_secrets_of_a_text_with_many_matches(spark):
    """Twice the matches in one text take about twice the time; repeated rows and columns of the same names as the operator's own."""
    import time

    def text(n):
        return " ".join(f"{k:032x} https://h{k}.example.com/x" for k in range(n))

    took = {}
    for n in (1000, 8000, 16_000):
        began = time.time()
        rows = find_secrets(spark.createDataFrame([(1, text(n)), (1, text(n))], "doc_id long, text string").selectExpr("*", "1 as row", "2 as s", "3 as k", "4 as e", "'x' as reach", "5 as weak")).collect()
        took[n] = time.time() - began
        assert len(rows) == 2 and rows[0] == rows[1]
        assert rows[0]["n_hex"] == n and rows[0]["n_linked"] == n and rows[0]["spans"].count("endpoint") == n
    assert took[16_000] < 2.5 * took[8000] + 2, took
    inside = "token=https://abcd.example.com/0123456789abcdef0123456789abcdef login: bob"
    got = find_secrets(spark.createDataFrame([(1, inside)], "doc_id long, text string")).first()["spans"]
    assert "hex:" in got and "id:" in got
