import re

from hypothesis import given, settings
from hypothesis import strategies as st

from kerbcast.llm.personal_data import all_spans, base_spans, luhn, masked_text, mod97, personal_data, without_personal_data


def plain_spans(text):
    """The base rules written as single expressions."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab1290.@+-% ()é\n5", max_size=60))
def test_base_rules(text):
    assert base_spans(text) == plain_spans(text)


def test_base_rules_on_made_values():
    # Spaces join digits of a card or phone, so other signs stand between the numbers.
    text = "x a.b@c.d.e@f.g, 1.2.3.4.5.6.7.8, 300.1.1.1; 4111 1111 1111 1111, +49 (30) 1234-5678; 0255.001.1.1 a@b.c@d.e"
    assert base_spans(text) == plain_spans(text)
    assert {k for k, _, _ in base_spans(text)} == {"email", "ip", "card", "phone"}


def test_long_runs_take_linear_time():
    for run in ("a" * 200_000, "1" * 200_000, "a@" * 50_000, "+1" * 50_000, "1.1." * 50_000, "1 " * 100_000):
        base_spans(run)


def test_checksums_and_context():
    assert mod97("GB82 WEST 1234 5698 7654 32") and not mod97("GB82 WEST 1234 5698 7654 33")
    kinds = lambda t: [k for k, *_ in all_spans(t)]
    assert kinds("IBAN GB82 WEST 1234 5698 7654 32 please") == ["iban"]
    assert kinds("code GB82 WEST 1234 5698 7654 33 please") == []
    assert kinds("my ssn: 123-45-6789") == ["ssn"] and kinds("part 123-45-6789") == []
    assert kinds("call (030) 123 4567 now") == ["local_phone"] and kinds("sum (030) 123 4567 now") == []


def test_numbers_that_cannot_be_given_out_and_keys():
    kinds = lambda t: [k for k, *_ in all_spans(t)]
    for wrong in ("000-12-3456", "666-12-3456", "900-12-3456", "123-00-4567", "123-45-0000", "000-00-0000"):
        assert kinds(f"my ssn: {wrong}") == []
    assert kinds("call 555-123-4567 now") == kinds("fax 555.123.4567,") == ["local_phone"]
    assert kinds("part 555-123-4567") == kinds("call 555-123.4567") == kinds("call 555-123-45678") == []
    key, token = "AKIA" + "ABCDEFGHIJKLMNOP", "ghp_" + "aB3" * 12
    for secret in (key, token, "-----BEGIN PRIVATE KEY-----", "-----BEGIN OPENSSH PRIVATE KEY-----"):
        (found,) = all_spans(f"x {secret} y")
        assert found[:3] == ("secret", 2, 2 + len(secret)) and 0.75 <= found[3] <= 1
        assert masked_text(f"x {secret} y", [found]) == "x [SECRET] y"
    assert kinds(f"x{key}") == kinds(key + "Q") == kinds(token + "x") == kinds("-----BEGIN PUBLIC KEY-----") == []


def made_iban(country, rest):
    return next(f"{country}{n:02d}{rest}" for n in range(2, 99) if mod97(f"{country}{n:02d}{rest}"))


def test_ibans_that_look_like_cards_are_reported():
    both = 0
    for n in range(200):
        iban = made_iban("AT", f"{10 ** 15 + 7919 * n:016d}")
        text = f"pay to {iban} now"
        spans = all_spans(text)
        both += any(k == "card" for k, *_ in spans)
        assert [text[s:e] for k, s, e, _ in spans if k == "iban"] == [iban]
        assert masked_text(text, spans) == "pay to [IBAN] now"
    assert both


def test_only_the_checksum_confirms_an_iban():
    for text in ("bank account IBAN GB82 WEST 1234 5698 7654 33", "konto GB82WEST12345698765433"):
        assert [k for k, *_ in all_spans(text)] == []
    found = lambda t: [t[s:e] for k, s, e, _ in all_spans(t) if k == "iban"]
    assert found("BE68 5390 0754 7034 CALL ME") == ["BE68 5390 0754 7034"]
    assert found("AB12 CDEF GHIJ GB82 WEST 1234 5698 7654 32") == ["GB82 WEST 1234 5698 7654 32"]
    all_spans("AB12 " * 40_000)


def test_masking():
    text = "mail a@b.co or +49 30 1234567!"
    assert masked_text(text, all_spans(text)) == "mail [EMAIL] or [PHONE]!"
    overlapping = "x +1.222.333.444 y"
    assert masked_text(overlapping, all_spans(overlapping)).startswith("x [")


def test_tables(documents, odd):
    rows = [*odd, (10, "é a@b.co")]
    got = personal_data(documents(rows)).collect()
    assert len(got) == len(rows)
    assert [(s.kind, s.start, s.end) for r in got if r.doc_id == 10 for s in r.spans] == [("email", 2, 8)]
    docs = documents(rows)
    out = without_personal_data(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[10] == "é [EMAIL]" and texts[1] is None
    assert personal_data(docs.limit(0)).count() == 0
