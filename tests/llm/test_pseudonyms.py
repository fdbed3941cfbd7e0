import hypothesis
import hypothesis.strategies as st
import pytest

from rosterline.llm import pseudonyms as p

KEY = b"test key"


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_permutation(size):
    assert sorted(p.permute(i, size, KEY, "t") for i in range(size)) == list(range(size))


def test_other_keys_permute_otherwise():
    assert [p.permute(i, 1000, KEY, "t") for i in range(50)] != [p.permute(i, 1000, b"other", "t") for i in range(50)]


@pytest.mark.parametrize("text, kind, shape", [
    ("4111 1111 1111 1111", "card", r"\d{4} \d{4} \d{4} \d{4}"),
    ("+1 (535) 555-5412", "phone", r"\+1 \(\d{3}\) \d{3}-\d{4}"),
    ("(535) 555-5412", "phone", r"\(\d{3}\) \d{3}-\d{4}"),
    ("238.202.104.165", "ip", r"\d{1,3}(\.\d{1,3}){3}"),
    ("123-45-6789", "ssn", r"\d{3}-\d{2}-\d{4}"),
    ("GB82 WEST 1234 5698 7654 32", "iban", r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d"),
    ("2024-02-29", "date", r"\d{4}-\d\d-\d\d"),
    ("29.02.2024", "date", r"\d\d\.\d\d\.\d{4}"),
    ("a.bc+d9@mail2.example.com", "email", r"[a-z]\.[a-z]{2}\+[a-z]\d@[a-z]{4}\d\.[a-z]{7}\.com"),
])
def test_format_is_kept_and_equal_values_stay_linked(text, kind, shape):
    import re

    for around in ("{}", "say {}, then", "({})", "{}.", '"{}"\n'):
        new, kinds = p.pseudonymise(around.format(text), KEY)
        head, tail = around.split("{}")
        inner = new[len(head) : len(new) - len(tail)]
        assert kinds == [kind] and new.startswith(head) and new.endswith(tail)
        assert re.fullmatch(shape, inner) and inner != text
    twice, _ = p.pseudonymise(f"{text} and {text}", KEY)
    assert twice == f"{inner} and {inner}"
    assert p.pseudonymise(inner, KEY)[1] == [kind]  # valid again


@pytest.mark.parametrize("text", [
    "4111 1111 1111 1111", "+1 (535) 555-5412", "238.202.104.165", "123-45-6789", "GB82 WEST 1234 5698 7654 32", "2024-02-29", "(535) 555-5412",
])
def test_letters_of_scripts_without_spaces_are_no_part_of_a_number(text):
    alone, kinds = p.pseudonymise(text, KEY)
    for around in ("卡号{}是", "カード{}です", "ที่{}ครับ", "я{}я", "号{}"):
        assert p.pseudonymise(around.format(text), KEY) == (around.format(alone), kinds)
    assert p.pseudonymise(f"x{text}", KEY)[1] == [] or text[0] in "+("


def test_equal_dates_stay_linked_over_notations():
    new = [p.pseudonymise(t, KEY)[0] for t in ("2024-03-31", "31.03.2024", "03/31/2024", "31/03/2024")]
    y, m, d = new[0].split("-")
    assert new[1:] == [f"{d}.{m}.{y}", f"{m}/{d}/{y}", f"{d}/{m}/{y}"]


@pytest.mark.parametrize("text", [
    "", None, "no numbers", "4111111111111112", "v1.2.3.4.5", "999.1.1.1", "2024-02-30", "000-12-3456", "12345", "a@b", "@", "x@y.",
    "84f85083df6ea7c09829aa66c61b0f3fa84f8508", "12.5 and 3.14159", "10:20:30", "99999999999999999999999",
])
def test_what_is_not_valid_stays(text):
    assert p.pseudonymise(text, KEY) == (text, [])


def test_rows(spark, awkward):
    got = p.pseudonyms(awkward, KEY)
    assert got.columns == [c for c in awkward.columns if c != "pseudonyms"] + ["pseudonyms"]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(((r.doc_id, r.text) for r in awkward.collect()), key=repr)
    assert p.pseudonyms(awkward.limit(0), KEY).count() == 0
    with pytest.raises(ValueError):
        p.pseudonyms(awkward, b"")


def test_clean_documents_are_left_alone(documents):
    rows = p.pseudonyms(documents, KEY).collect()
    before = {r.doc_id: r.text for r in documents.collect()}
    assert all((r.text != before[r.doc_id]) == bool(r.pseudonyms) for r in rows)
    assert all(r.text == before[r.doc_id] for r in rows if not any(c.isdigit() or c == "@" for c in before[r.doc_id]))


@pytest.mark.parametrize("said, kind", [
    ("4111 1111 1111 1111 12/27", "card"), ("4111 1111 1111 1111 123", "card"), ("4111.1111.1111.1111", "card"), ("4111111111111111 123", "card"),
    ("3782 822463 10005 12/27", "card"), ("BE68 5390 0754 7034 EUR", "iban"), ("AT61 1904 3002 3457 3201 IBAN", "iban"),
    ("+33 6 12 34 56 78", "phone"), ("06 12 34 56 78", "phone"), ("jürgen@example.com", "email"), ("bob@müller.de", "email"),
])
def test_values_before_other_numbers_and_words(said, kind):
    new, kinds = p.pseudonymise(f"see {said} there", b"key")
    assert kinds == [kind] and new != f"see {said} there"
    part = {"card": said[:16], "iban": said[5:19], "phone": said[4:], "email": said.partition("@")[0]}[kind]
    assert part not in new


@hypothesis.settings(max_examples=300, deadline=None)
@hypothesis.given(st.text("0123456789", min_size=15, max_size=15), st.lists(st.one_of(st.text("0123456789", min_size=1, max_size=4), st.sampled_from("EUR IBAN and CVV 12/27".split())), max_size=3), st.sampled_from([" ", "-"]))
def test_a_valid_card_is_found_whatever_follows(digits, after, mark):
    number = "4" + digits[1:]
    number += str(-p.luhn_sum(number + "0") % 10)
    grouped = mark.join(number[i : i + 4] for i in range(0, 16, 4))
    new, kinds = p.pseudonymise(" ".join([grouped, *after]), b"key")
    assert kinds[:1] == ["card"]


@hypothesis.settings(max_examples=300, deadline=None)
@hypothesis.given(st.text("0123456789", min_size=18, max_size=18), st.lists(st.one_of(st.text("0123456789", min_size=1, max_size=4), st.sampled_from("EUR IBAN and BIC 12/27".split())), max_size=3))
def test_a_valid_iban_is_found_whatever_follows(digits, after):
    check = 98 - int(digits + "131400") % 97  # DE is 13 14
    whole = f"DE{check:02d}{digits}"
    grouped = " ".join(whole[i : i + 4] for i in range(0, 22, 4))
    new, kinds = p.pseudonymise(" ".join([grouped, *after]), b"key")
    assert kinds[:1] == ["iban"] and whole[4:8] + " " + whole[8:12] + " " + whole[12:16] not in new


def test_clean_numbers_stay():
    for text in ("in 1999 there were 12 345 678 people", "chapters 1.2.3 and 10.11", "call 112 or 110", "04 05 06", "version 10.04.1"):
        assert p.pseudonymise(text, b"key") == (text, [])
