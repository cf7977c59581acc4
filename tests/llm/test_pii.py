import datetime
import re

from sportlake.llm.pii import DAYS, FIRST_DAY, Pseudonyms, iban_check, luhn, pseudonymised

KEY = b"test"


def test_values_keep_their_format_and_links():
    own = Pseudonyms(KEY)
    card = "4111 1111 1111 1111"
    text, counts = own.text(f"Pay {card} or {card.replace(' ', '')} or {card.replace(' ', '-')}.")
    found = [re.sub(r"\D", "", x) for x in re.findall(r"\d[\d -]+\d", text)]
    assert counts == {"card": 3} and len(set(found)) == 1 and found[0] != "4" + "1" * 15
    assert luhn(found[0][:-1]) == int(found[0][-1])
    assert re.fullmatch(r"Pay \d{4} \d{4} \d{4} \d{4} or \d{16} or \d{4}-\d{4}-\d{4}-\d{4}\.", text)
    text, counts = own.text("born 1980-02-29, 29.02.1980, 29/2/1980")
    days = re.findall(r"\d+", text)
    assert counts == {"date": 3}
    assert (days[0], int(days[1]), int(days[2])) == (days[5], int(days[4]), int(days[3])) == (days[8], int(days[7]), int(days[6]))
    text, counts = own.text("IBAN DE89 3704 0044 0532 0130 00, IP 10.0.0.1. Mail a.b@x.org +1 (212) 555-7713")
    assert counts == {"iban": 1, "ip": 1, "email": 1, "phone": 1}
    iban = re.search(r"DE[\d ]+", text)[0].replace(" ", "")
    assert iban_check("DE", iban[4:]) == iban[2:4] and "@x.org" in text and "+1 (" in text


def test_invalid_values_stay():
    own = Pseudonyms(KEY)
    for text in ("on 2021-13-41", "at 300.1.2.3", "version 4.0 of 2021", "DE00 3704 0044 0532 0130 00"[:9]):
        assert own.text(text)[0] == text


def test_round_trip_and_permutation():
    own, back = Pseudonyms(KEY), Pseudonyms(KEY, back=True)
    for kind, size in (("a", 1), ("b", 7), ("c", 1000), ("date", DAYS)):
        step = max(1, size // 1000)
        images = [own.number(kind, v, size) for v in range(0, size, step)]
        assert len(set(images)) == len(images) and [back.number(kind, v, size) for v in images] == list(range(0, size, step))
    for text in ("4111-1111-1111-1111", "9807915762804490", "97.51.17.173", "(017) 555-7713", "123-45-6789",
                 "1999-12-31", "31/12/1999", "a1b2c3" * 8 + "00", "ab" * 20, "DE89370400440532013000"):
        assert back.text(own.text(text)[0])[0] == text
    assert Pseudonyms(b"other").text("9807915762804490") != own.text("9807915762804490")
    assert FIRST_DAY + datetime.timedelta(DAYS - 1) == datetime.date(2099, 12, 31)


def test_rows(odd, empty, frame):
    found = pseudonymised(odd, KEY).collect()
    assert len(found) == 11 and all(r.n_values == 0 for r in found)
    assert {r.doc_id: r.text for r in found}[3] is None
    assert pseudonymised(empty, KEY).collect() == []
    rows = pseudonymised(frame([(1, "call 123456789"), (2, "id 123456789!")]), KEY).collect()
    a, b = (re.search(r"\d{9}", r.text)[0] for r in rows)
    assert a == b != "123456789" and [r.n_number for r in rows] == [1, 1]


def test_one_value_in_several_forms():
    own = Pseudonyms(KEY)

    def digits(text):
        new, counts = own.text(text)
        assert sum(counts.values()) == 1 and new != text, text
        return re.sub(r"\D", "", new)

    assert digits("123-45-6789") == digits("123456789") == digits("123 45 6789") != "123456789"
    assert digits("(212) 555-7713") == digits("2125557713") == digits("212-555-7713") != "2125557713"
    assert digits("+1 (212) 555-7713") == digits("12125557713") == "1" + digits("2125557713")


def test_documents_equal_one_by_one(frame):
    """Every value looked up in a permutation built anew for each row."""
    texts = ["a 123-45-6789 b", "x 123456789", None, "", "c@d.org 10.0.0.1", "4111 1111 1111 1111", "no", "1999-12-31"] * 3
    found = pseudonymised(frame(list(enumerate(texts))), KEY).collect()
    want = {i: Pseudonyms(KEY).text(t)[0] if t else t for i, t in enumerate(texts)}
    assert {r.doc_id: r.text for r in found} == want
    back = {r.doc_id: Pseudonyms(KEY, back=True).text(r.text)[0] if r.text else r.text for r in found}
    assert back == dict(enumerate(texts))
