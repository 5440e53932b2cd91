"""PII: valid values go and stay linked, invalid ones stay, formats hold, the permutation is one."""

import re

import pytest

from tidemart.llm import pii, queries

P = pii.Pseudonyms(b"test")


def new(text):
    return pii.replaced(text, P)[0]


@pytest.mark.parametrize("text, shape", [
    ("card 4111111111111111.", r"card \d{16}\."), ("4111 1111 1111 1111", r"(\d{4} ){3}\d{4}"), ("3782-822463-10005", r"\d{4}-\d{6}-\d{5}"),
    ("Call +1 (017) 555-7713 now", r"Call \+1 \(\d{3}\) \d{3}-\d{4} now"), ("(212) 555-0100", r"\(\d{3}\) \d{3}-\d{4}"),
    ("212-555-0100", r"\d{3}-\d{3}-\d{4}"), ("+49 30 1234567!!", r"\+49 \d\d \d{7}!!"),
    ("from 97.51.17.173, or", r"from \d+\.\d+\.\d+\.\d+, or"), ("078-05-1120", r"\d{3}-\d\d-\d{4}"),
    ("born 1984-02-29;", r"born \d{4}-\d\d-\d\d;"), ("31.12.1999.", r"\d\d\.\d\d\.\d{4}\."), ("12/31/1999", r"\d\d/\d\d/\d{4}"), ("1/2/2003", r"\d+/\d+/\d{4}"),
    ("GB82 WEST 1234 5698 7654 32", r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d"), ("DE89370400440532013000", r"DE\d{20}"),
    ("x und.34@mail7.example.com y", r"x [a-z]{3}\.\d\d@mail7\.example\.com y"), ("Ab@c.de###", r"[A-Z][a-z]@c\.de###"),
    ('token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"', r'token = "[0-9a-f]{40}"'), ("TOKEN = \"9233A8ECF7C5B09F\"!!", r'TOKEN = "[0-9A-F]{16}"!!'),
])
def test_valid_values(text, shape):
    assert new(text) != text and re.fullmatch(shape, new(text))
    assert new(f"a {text} b\n{text}").count(new(text)) == 2


@pytest.mark.parametrize("text", [
    "", "no numbers", "4111111111111112", "0000000000000000", "1234567", "999.1.1.1", "1.2.3", "1.2.3.4.5", "2023-02-30", "1850-01-01", "000-12-3456",
    "666-12-3456", "DE88370400440532013000", "version 4.0", "a@b", "@ home", "token = \"nothex\"", "in 1999", "x4111111111111111y",
    "41111111111111114111111111111111", "12345678901234567890",
])
def test_all_else_stays(text):
    assert new(text) == text


def iban(country, account):
    return f"{country}{98 - pii._mod97(f'{country}00{account}'):02d}{account}"


@pytest.mark.parametrize("country, account", [
    ("ES", "21000418450200051332"), ("BE", "539007547034"), ("PL", "109010140000071219812874"), ("AT", "1904300234573201"),
    ("SE", "50000000058398257466"), ("CZ", "65080000192000145399"), ("LU", "0019400644750000"), ("DE", "370400440532013000")])
@pytest.mark.parametrize("after", ["", " and", " AND", " IBAN", " I am", " 1234", " A1", ", and", " THE END"])
def test_ibans_before_another_word(country, account, after):
    plain = iban(country, account)
    text = " ".join(re.findall(".{1,4}", plain))
    changed = new(f"pay {text}{after}")
    assert changed.startswith("pay ") and changed.endswith(after) and len(changed) == len(f"pay {text}{after}")
    assert changed[4:len(changed) - len(after)].replace(" ", "") == P.iban(plain)


def test_values_behind_a_failed_match():
    assert new("AB12 CDEF 4111 1111 1111 1111") == f"AB12 CDEF {P.card('4111 1111 1111 1111')}"
    assert new("1234 4111 1111 1111 1111") == f"1234 {P.card('4111 1111 1111 1111')}"


def test_dates_with_a_time():
    for day in ("1984-02-29", "2024/05/01"):
        assert new(f"at {day}T10:00Z") == f"at {P.date(day)}T10:00Z"
    assert new("1984-02-30T10:00Z") == "1984-02-30T10:00Z" and new("1984-02-29Tx") == "1984-02-29Tx"


@pytest.mark.parametrize("phone", ["+49 30 1234567", "+1 212 555 0100", "+44 20 7946 0958", "+33 1 23 45 67 89", "+1 (212) 555-0100", "+41 44 668 18 00"])
def test_phones_before_another_number(phone):
    for day in ("2024-05-01", "01.05.2024", "5/1/2024"):
        assert new(f"{phone} {day}") == f"{P.phone(phone)} {P.date(day)}"
    for after in (" 12345 items", " 2024", ", 17", " x"):
        assert new(phone + after) == P.phone(phone) + after
    assert new("+49 171 12 34 56 78") == P.phone("+49 171 12 34 56 78")


def test_failed_matches_take_linear_time():
    for bad in ("4111 " * 5_000, "ES91 " * 5_000, "+49 30 " * 5_000):
        assert len(new(bad)) == len(bad)


def test_pseudonyms_validate_and_stay_linked():
    for i in range(200):
        body = f"4{i:014d}"
        card = new(body + pii._luhn(body))
        assert len(card) == 16 and card[-1] == pii._luhn(card[:-1])
        grouped = new(" ".join(re.findall("....", body + pii._luhn(body))))
        assert grouped.replace(" ", "") == card
    assert pii._mod97(new("GB82WEST12345698765432")) == 1
    assert new("+1 (017) 555-7713").replace(" ", "") == new("+1(017)555-7713")
    assert re.sub(r"\D", "", new("+1 (212) 555-7713")) == re.sub(r"\D", "", new("+1-212-555-7713"))
    assert pii.Pseudonyms(b"other").card("4111111111111111") != P.card("4111111111111111")


@pytest.mark.parametrize("n", [2, 3, 10, 97, 1000, 4096])
def test_permutation_without_fixed_points(n):
    image = [P.permute(x, n, "t") for x in range(n)]
    assert sorted(image) == list(range(n)) and all(x != y for x, y in enumerate(image))


def test_spans_and_rows(spark):
    docs = [(1, None), (2, ""), (3, "é 97.51.17.173\nand 4111111111111111 ok"), (4, "clean\ntext"), (5, "x " * 500_000 + "a@b.com"), (5, "clean")]
    df = spark.createDataFrame([(*d, "k") for d in docs], "doc_id long, text string, found string")
    rows = pii.pseudonymise(df, b"k").collect()
    by_id = {r.doc_id: r for r in rows[:5]}
    assert len(rows) == 6 and by_id[1].text is None and by_id[2].text == "" and by_id[4].text == "clean\ntext"
    assert [(f.kind, by_id[3].text[f.start:f.end]) for f in by_id[3].found] == [
        ("ip", pii.Pseudonyms(b"k").ip("97.51.17.173")), ("card", pii.Pseudonyms(b"k").card("4111111111111111"))]
    assert len(by_id[5].text) == 1_000_007 and not by_id[5].text.endswith("a@b.com")
    assert pii.pseudonymise(df.limit(0), b"k").count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op6_pii(spark, sf).collect()
    assert len(rows) == len(texts) and sum(r.n_found for r in rows) > 5
    email = re.compile(r"\S+@mail\d\.example\.com")
    for r in rows:
        assert len(r.text) >= len(texts[r.doc_id]) - 12 * r.n_found
        assert not set(email.findall(texts[r.doc_id])) & set(email.findall(r.text))
        if not r.n_found:
            assert r.text == texts[r.doc_id]
