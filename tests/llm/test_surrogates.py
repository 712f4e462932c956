import re

from pyspark.sql import functions as F

from peakloom.llm import surrogates
from peakloom.session import Scratch

SCHEMA = "doc_id bigint, text string, n_chars bigint, identity string"


def _luhn(number):
    digits = [int(d) for d in number]
    return (sum(digits[-1::-2]) + sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2])) % 10 == 0


def _run(spark, texts, key="k"):
    docs = spark.createDataFrame([(i, t, None if t is None else len(t), "own") for i, t in enumerate(texts)], SCHEMA)
    out = surrogates.pseudonymise(docs, key)
    assert out.columns == [*docs.columns, "n_mentions"]
    rows = {r.doc_id: r for r in out.collect()}
    assert all(r.identity == "own" and (r.text is None or r.n_chars == len(r.text)) for r in rows.values())
    return [rows[i].text for i in range(len(texts))], [rows[i].n_mentions for i in range(len(texts))]


def test_types_formats_and_coreference(spark):
    texts = [
        "Write Anna.Smith7@mail9.example.com or ANNA.SMITH7@MAIL9.EXAMPLE.COM, call +1 (359) 555-3724 or 359-555-3724.",
        "Hosts 89.189.210.185, 10.0.0.1 and fe80:1:2:3:4:5:6:7; card 4111 1111 1111 1111 and 4489414937100514!",
        "Dr Maria Lopez met Ms Lopez; Иван Петров, Νίκος Παππάς; 123-45-6789; DE89370400440532013000; +49 30 1234567",
        None,
        "",
        "Nothing to see: 1.2.3, 12:30, 2024-05-06, version 1.2.3.4.5, a@b, 555",
        "word " * 20_000 + "x.y@z.org",
        "Dr Maria Lopez met Ms Lopez; Иван Петров, Νίκος Παππάς; 123-45-6789; DE89370400440532013000; +49 30 1234567",
    ]
    out, counts = _run(spark, texts)
    assert counts == [4, 5, 7, 0, 0, 0, 1, 7]
    assert out[3:6] == texts[3:6] and out[7] == out[2]
    mails = re.findall(r"[\w.]+@[\w.]+", out[0])
    assert mails[0].upper() == mails[1].rstrip(",") and re.fullmatch(r"[a-z]{4}\.[a-z]{5}\d@[a-z]{4}\d\.example\.com", mails[0])
    assert "anna" not in out[0].lower()
    one, two = re.findall(r"\(\d{3}\) \d{3}-\d{4}|\d{3}-\d{3}-\d{4}", out[0])
    assert re.sub(r"\D", "", one) == re.sub(r"\D", "", two) != "3595553724" and "+1 (" in out[0]
    assert re.search(r"Hosts 2[45]\d\.\d+\.\d+\.\d+, 2[45]\d\.\d+\.\d+\.\d+ and 2001:db8(:[0-9a-f]{4}){6}; card \d{4} \d{4} \d{4} \d{4} and 4\d{15}!", out[1])
    assert _luhn(re.search(r"card ([\d ]+) and", out[1])[1].replace(" ", ""))
    given, surname, again = re.match(r"Dr (\w+) (\w+) met Ms (\w+);", out[2]).groups()
    assert given in surrogates.GIVEN["f", "latin"] and surname == again != "Lopez"
    assert re.search(r"; [А-Я][а-я]+ [А-Я][а-я]+, [Α-Ωά-ώΆ-Ώ]\w+ \w+; 9\d\d-\d\d-\d{4}; DE\w{20}; \+49 \d\d \d{7}", out[2])
    assert "z.org" not in out[6] and len(out[6]) > 100_000


def test_names_beyond_the_surrogates(spark):
    """Unlisted given names after titles, listed ones without, and whole runs of words with what joins them."""
    texts = [
        "Mary Johnson and Robert Smith",
        "Mrs. Mary Johnson, Dr. Robert Smith, Frau Prof. Dr. Zyta Quork",
        "Anna Smith-Jones; Maria Garcia Lopez; John O'Brien's",
        "Mr. J. R. Tolkien, Mrs. Maria de la Cruz, MS. and Ms SMITH; Anna Smith Mr. Jones",
        "Dr " + "Lorem " * 5_000 + "end",
        "The House of Commons; Del Monte; Will Congress Act; Dr. who",
    ]
    out, counts = _run(spark, texts)
    assert counts == [2, 3, 3, 5, 1, 0] and out[5] == texts[5]
    one = re.fullmatch(r"([A-Z]\w+(?:-\w+)*) ([A-Z]\w+) and ([A-Z]\w+(?:-\w+)*) ([A-Z]\w+)", out[0]).groups()
    two = re.fullmatch(r"Mrs\. (\S+) (\w+), Dr\. (\S+) (\w+), Frau Prof\. Dr\. \S+ \w+", out[1])
    assert two.groups() == one and two[1].split("-")[0] in surrogates.GIVEN["f", "latin"]
    assert two[3].split("-")[0] in surrogates.GIVEN["m", "latin"]
    smith = one[3]
    assert re.fullmatch(rf"\S+ {smith}-[A-Z]\w+; \S+ \w+ \w+; \S+ O'[A-Z]\w+'s", out[2])
    assert re.fullmatch(rf"Mr\. ([A-Z])\. \1\. \1\w+, Mrs\. \S+ de la \w+, MS\. and Ms {smith.upper()}; \S+ {smith} Mr\. \w+", out[3])
    real = "Mary Johnson Robert Smith Zyta Quork Jones Garcia Lopez Brien Tolkien Cruz SMITH Lorem".split()
    assert not set(real) & set(re.findall(r"\w+", " ".join(out[:5])))


def test_other_forms_of_numbers(spark):
    texts = [
        "2001:db8::8a2e:370:7334 = 2001:0DB8:0:0:0:8a2e:370:7334; ::1, 1:2:3:4:5::6:7; ::ffff:192.168.0.1",
        "DE89 3704 0044 0532 0130 00 EUR, DE89370400440532013000; NO93 8601 1117 947; FR14 2004 1010 0505 0001 3M02 606",
        "3782 822463 10005, 378282246310005; 3056-930902-5904",
        "020 7946 0958, +44 20 7946 0958, (020) 7946 0958; 06 12 34 56 78, +33 6 12 34 56 78, 0612345678; 5551234567, 555-123-4567",
        "std::vector a::b 12:30:45 1::2::3 01.02.2024 10:30 01-02-2024 10 1712345678 AB12 THIS WORD",
    ]
    out, counts = _run(spark, texts)
    assert counts == [5, 4, 3, 8, 0] and out[4] == texts[4]
    full = "2001:db8(?::[0-9a-f]{4}){6}"
    assert re.fullmatch(rf"({full}) = \1; {full}, {full}; ::ffff:2[45]\d\.\d+\.\d+\.\d+", out[0])
    one, two, norway, france = re.split("[,;] ", out[1])
    assert one == re.sub("(.{4})(?=.)", r"\1 ", two) + " EUR" and two != "DE89370400440532013000"
    assert re.fullmatch(r"NO\d\d \d{4} \d{4} \d{3}", norway) and re.fullmatch(r"FR\d\d( \d{4}){4} \d[A-Z]\d\d \d{3}", france)
    grouped, plain, other = re.split("[,;] ", out[2])
    assert re.fullmatch(r"\d{4} \d{6} \d{5}", grouped) and grouped.replace(" ", "") == plain != "378282246310005"
    assert re.fullmatch(r"\d{4}-\d{6}-\d{4}", other) and other != "3056-930902-5904"
    assert [re.sub(r"\d", "9", t) for t in out] == [re.sub(r"\d", "9", t) for t in (*out[:3], texts[3], texts[4])]
    for group in out[3].split("; "):
        assert len({re.sub(r"^(\+(44|33)|0)", "", re.sub(r"[^\d+]", "", n)) for n in group.split(", ")}) == 1
    assert not set(re.split("[,;] ", out[3])) & set(re.split("[,;] ", texts[3]))


def test_check_sums_decide(spark):
    """Numbers of the shape of a card or an account whose check sum fails, and versions, are no personal data."""
    texts = [
        "order 1234567890123, ISBN 9780306406158, 4111 1111 1111 1112; DE89370400440532013001, DE88 3704 0044 0532 0130 00",
        "version 1.2.3.4, Release: 10.0.0.1, ver. 9.9.9.9, firmware 4.3.2.1",
        "card 4111111111111111, account GB82 WEST 1234 5698 7654 32, host 1.2.3.4",
    ]
    out, counts = _run(spark, texts)
    assert out[:2] == texts[:2] and counts == [0, 0, 3]
    card, account, host = re.fullmatch(r"card (\d{16}), account (GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d), host ([\d.]+)", out[2]).groups()
    plain = account.replace(" ", "")
    assert _luhn(card) and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    assert 240 <= int(host.split(".")[0]) <= 255 and card != "4111111111111111" and plain != "GB82WEST12345698765432"


def test_addresses_in_other_scripts(spark):
    texts = ["müller@x.de, a@bücher.de; ИВАН.петров7@почта.рф = иван.Петров7@почта.рф", "νίκος@mail.gr und MÜLLER@X.DE"]
    out, counts = _run(spark, texts)
    assert counts == [4, 2]
    one, two, three, four = re.split("[,;=] ?", out[0].replace(" =", "="))
    assert re.fullmatch(r"[a-z]{6}@example\.de", one) and re.fullmatch(r"[a-z]@example\.de", two)
    assert re.fullmatch(r"[а-я]{4}\.[а-я]{6}\d@example\.рф", three.lower()) and three == four
    assert out[1].endswith(f" und {one.upper()}") and re.match(r"[α-ω]{5}@example\.gr", out[1])
    assert not re.search("müller|ller|bücher|иван|петров|νίκος", " ".join(out).lower())


def test_marks_of_the_private_use_area(spark):
    texts = ["a\ue001b \ue000\ue002 x.y@z.org \ue000\ue003\ue001", "\ue001x.y@z.org\ue000", "\ue000\ue001 none"]
    out, counts = _run(spark, texts)
    mail = re.search(r"\S+@example\.org", out[0])[0]
    assert counts == [1, 1, 0] and out == [t.replace("x.y@z.org", mail) for t in texts[:2]] + texts[2:]


def test_columns_of_the_same_names(spark):
    """A column called like the output is replaced, in whatever case; others keep their names and values."""
    schema = "N_Mentions string, __row int, __pieces int, __MADE int, __new int, m int, r int, identity int, text string, N_CHARS int"
    docs = spark.createDataFrame([("x", 1, 2, 3, 4, 5, 6, 7, "to x.y@z.org", 12), ("x", 1, 2, 3, 4, 5, 6, 7, "-", 1)], schema)
    out = surrogates.pseudonymise(docs, "k")
    assert out.columns == [*docs.columns[1:], "n_mentions"]
    for row in out.collect():
        assert tuple(row)[:7] == (1, 2, 3, 4, 5, 6, 7) and row.N_CHARS == len(row.text) and row.n_mentions == (row.text != "-")


def test_plans_stay_small(spark, monkeypatch):
    """No written step repeats the pattern of all mentions or the list of names inside another."""
    sizes = {}
    save = Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, name: sizes.update({name: _plan(df)}) or save(self, df, name))
    docs = spark.createDataFrame([(0, "Dr Maria Lopez, x.y@z.org", 1, "own")], SCHEMA)
    sizes["result"] = _plan(surrogates.pseudonymise(docs, "k"))
    assert len(sizes) >= 10 and max(sizes.values()) < 60_000, sizes


def _plan(df):
    return len(df._jdf.queryExecution().optimizedPlan().toString())


def test_surrogate_names_do_not_run_out(spark):
    """Late attempts draw from more names than four of six make."""
    given = F.concat(F.lit("given:f:greek:"), F.col("id").cast("string"))
    drawn = spark.range(3000).select(surrogates._draw(given, F.lit(14), "k").alias("drawn"))
    assert drawn.distinct().count() > 2_900


def test_distinct_people_stay_distinct(spark):
    """Two hundred one-letter addresses and numbers in a small range force collisions."""
    mails = [f"{c}{d}@x.org" for c in "abcdefghijklmnopqrst" for d in range(10)]
    names = [f"Anna {a}{b}nova" for a in "BCDFGHKLMN" for b in "aeiou"]
    cards = [n for n in (f"{4000000000000 + i}" for i in range(600)) if _luhn(n)][:50]
    texts = [f"{m} and {n} with {c}" for m, n, c in zip(mails, names * 4, cards * 4, strict=True)]
    out, _ = _run(spark, texts)
    got = [re.match(r"(\S+@\S+) and (.+) with (\d+)$", t).groups() for t in out]
    assert len({g[0] for g in got}) == 200 and not {g[0] for g in got} & set(mails)
    assert len({g[1] for g in got}) == 50 and len({g[2] for g in got}) == 50
    assert {g[2] for g in got}.isdisjoint(cards)
    again, _ = _run(spark, texts)
    other, _ = _run(spark, texts, key="another")
    assert again == out != other


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert surrogates.pseudonymise(docs, "k").count() == 0
