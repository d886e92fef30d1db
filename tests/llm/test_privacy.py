from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from riskmart.llm import privacy

from .conftest import prose

KEY = "test"


def replaced(docs, key=KEY):
    return {r.doc_id: r for r in privacy.replace_entities(docs, key).collect()}


def luhn(digits):
    total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


TEXT = (
    "Mail und.34@mail7.example.com, JANE.DOE@MAIL.EXAMPLE.ORG or jane.doe@mail.example.org; call +1 (017) 555-7713 or "
    "(017) 555-7713; cards 4111 1111 1111 1111, 4111-1111-1111-1111, 9807915762804490$$$; host 152.143.123.131. "
    "SSN 123-45-6789; Frau Anna Müller and Mr. Müller, Госпожа Анна Петрова, Κύριος Γιώργος."
)


def test_formats_and_coreference(make_docs):
    row = replaced(make_docs([(1, TEXT)], clash=False))[1]
    shape = lambda t: re.sub(r"\d+", "9", re.sub(r"[^\W\d_]+", "a", t))
    assert shape(row.text) == shape(TEXT) and row.text != TEXT
    for old in ("und.34", "017", "4111", "9807915762804490", "152.143", "123-45", "Müller", "Петрова", "Γιώργος"):
        assert old not in row.text
    mails = re.findall(r"\S+@\S+[a-zA-Z]", row.text)
    assert mails[1].lower() == mails[2] and mails[1].isupper() and mails[0] != mails[1]
    phones = re.findall(r"\(\d{3}\) \d{3}-\d{4}", row.text)
    assert phones[0] == phones[1] and "+1 (" in row.text
    cards = [re.sub("[ -]", "", c) for c in re.findall(r"\d(?:[ -]?\d){15}", row.text)]
    assert cards[0] == cards[1] and luhn(cards[0]) and cards[0][0] == "4" and luhn(cards[2]) == luhn("9807915762804490")
    assert re.search(r"host 2(4\d|5[0-4])\.", row.text) and re.search(r"SSN 9\d\d-\d\d-\d{4}", row.text)
    frau, mister = re.search(r"Frau (\S+) (\S+) and Mr\. (\S+),", row.text).group(1, 2), re.search(r"Mr\. (\S+),", row.text)[1]
    assert frau[0].endswith("na") and frau[1] == mister
    assert re.search(r"Госпожа [а-яА-Я]+ва [а-яА-Я]+,", row.text) and re.search(r"Κύριος [α-ωςΑ-Ω]+\.", row.text)
    assert (row.n_email, row.n_phone, row.n_card, row.n_ip, row.n_ssn, row.n_person) == (3, 2, 3, 1, 1, 4)


NAMES = [
    "Mrs Anna-Lena Müller-Schmidt", "Mr McDonald", "MR JONES", "Mr van der Berg", "Mr O'Brien", "Dr. Watson", "Prof. Moriarty",
    "Mr J. R. Smith", "Frau von Trapp", "Monsieur d'Artagnan de la Tour", "MRS. MARY O’NEIL-JONES", "Mr John Paul George Ringo Pete", "Dr Élodie Dupont",
]


def test_no_part_of_a_name_survives(make_docs):
    rows = replaced(make_docs([(i, f"then {name} came.") for i, name in enumerate(NAMES)], clash=False))
    for i, name in enumerate(NAMES):
        new = rows[i].text.removeprefix("then ").removesuffix(" came.")
        kept = {w for w in re.findall(r"\w+", name) if len(w) > 1 and w not in privacy.PARTICLES} & set(re.findall(r"\w+", new))
        title = name.split()[0]
        assert kept <= {title.rstrip(".")} and new.startswith(title) and rows[i].n_person == 1, (name, new)
        same = lambda t: re.sub(r"[^\W\d_]+", lambda m: m[0] if m[0] in privacy.PARTICLES else "A" if m[0].isupper() and len(m[0]) > 1 else "a", t)
        assert same(new) == same(name), (name, new)
    assert rows[1].text.split()[2][2].isupper() and rows[2].text.split()[2].isupper()


def test_coreference_across_spellings(make_docs):
    text = "Mr John Smith met MR JOHN SMITH. John Smith left, John Smithson and St John Smith-Jones stayed; JANE.Doe@X.org is jane.doe@x.ORG."
    row = replaced(make_docs([(1, text), (2, "John Smith is unknown here")], clash=False))
    first = re.match(r"Mr (\w+ \w+) met MR ([A-Z]+ [A-Z]+)\. (\w+ \w+) left", row[1].text)
    assert first and first[1].upper() == first[2] and first[3] == first[1] and "John Smith" not in first[0]
    assert "John Smithson" in row[1].text and row[2].text == "John Smith is unknown here"
    a, b = re.findall(r"\S+@\S+[a-zA-Z]", row[1].text)
    assert a.lower() == b.lower() and a.split("@")[0][:4].isupper() and a.split("@")[0][5].isupper() and b.endswith("ORG") and b[:4].islower()


def test_titles_in_clean_texts(make_docs):
    rows = {1: "MS Word and DR drive", 2: "Missing Mr", 3: "Sr. manager of the Drs", 4: "profane Professional Doctors"}
    assert {i: r.text for i, r in replaced(make_docs(list(rows.items()), clash=False)).items()} == rows


def test_key_decides_and_runs_agree(make_docs):
    docs = make_docs([(1, TEXT), (2, "und.34@mail7.example.com")], clash=False)
    one, again, other = replaced(docs), replaced(docs), replaced(docs, "other")
    assert one[1].text == again[1].text != other[1].text
    assert one[2].text in one[1].text


def test_short_formats_stay_distinct(make_docs):
    """All addresses of a format with little room: the draws must collide, the surrogates must not."""
    names = [f"{a}.{d}@x.co" for a in "abcdefghijklmnopqrstuvwxyz" for d in range(10)]
    rows = replaced(make_docs([(i, f"to {n} now") for i, n in enumerate(names)], clash=False))
    found = [rows[i].text.split()[1] for i in range(len(names))]
    assert len(set(found)) == len(names) and not set(found) & set(names)


def test_one_word_names_do_not_run_out(spark):
    """More names than four syllables of 16 give."""
    names = spark.range(70_000).selectExpr("'person' AS kind", "concat('m:s', translate(string(id), '0123456789', 'abcdefghij')) AS identity")
    found = privacy.draw_surrogates(names, KEY)
    assert found.count() == found.select("surrogate").distinct().count() == 70_000
    assert found.join(names.select(F.col("identity").alias("surrogate")), "surrogate").isEmpty()
    assert found.filter(~F.col("surrogate").rlike("^m:[a-z]{8,}$")).isEmpty()


def test_draws_end_with_an_error(spark, monkeypatch):
    monkeypatch.setattr(privacy, "surrogate_of", lambda kind, identity, key, draw: F.lit("same"))
    with pytest.raises(RuntimeError):
        privacy.draw_surrogates(spark.createDataFrame([("ip", "1.2.3.4"), ("ip", "1.2.3.5")], "kind string, identity string"), KEY)


def test_clean_texts_are_left_alone(make_docs):
    rows = {1: prose(1, 500), 2: "In 2015 and 2016, 999.1.1.1 or 1.2.3 of 12,000 at 10:30", 3: "a@b", 4: "Mr. smith met Frau", 5: "deadbeef12345678901234567890"}
    found = replaced(make_docs(list(rows.items()), clash=False))
    assert {i: r.text for i, r in found.items()} == rows and all(r.n_email + r.n_ip + r.n_phone + r.n_card + r.n_person == 0 for r in found.values())


def test_long_tokens_take_linear_time(make_docs):
    text = "a" * 300_000 + " " + "1.2" * 50_000 + " x@" + "y." * 20_000
    assert replaced(make_docs([(1, text)], clash=False))[1].text == text


def test_odd_rows(odd_docs, make_docs):
    found = privacy.replace_entities(odd_docs, KEY)
    assert found.columns == [*odd_docs.columns, *(f"n_{k}" for k in privacy.KINDS)]
    assert sorted(map(str, found.select(*odd_docs.columns).collect())) == sorted(map(str, odd_docs.collect()))
    assert privacy.replace_entities(odd_docs.limit(0), KEY).collect() == []
    twice = [(1, "to a.1@b.co"), (1, "to a.1@b.co"), (None, "to a.1@b.co"), (None, None)]
    rows = privacy.replace_entities(make_docs(twice).withColumn("n_email", F.lit("old")), KEY).collect()
    assert len(rows) == 4 and len({r.text for r in rows}) == 2 and sorted(r.n_email for r in rows) == [0, 1, 1, 1]


def test_no_python_in_the_plan(make_docs):
    plan = privacy.replace_entities(make_docs([(1, TEXT)]), KEY)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
