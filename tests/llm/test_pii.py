"""Base spans against plain patterns, and what the field adds."""

import hashlib
import re

import pytest
from compare import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st

from vecloom.llm import pii
from vecloom.llm.queries import QUERIES

# The patterns as the contract states them.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            fits = {
                "email": True,
                "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                "card": 12 <= len(digits) <= 19 and sum(n - 9 if n > 9 else n for n in doubled) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fits:
                out.append((m.start(), m.end(), k))
    return sorted(out, key=lambda s: (s[0], s[2]))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1234567890@.+-() _é\n", max_size=60))
def test_base_spans_equal_plain_patterns(text):
    assert pii.base_spans(text) == plain(text)


@pytest.mark.parametrize("text", [
    "", "a@b.c@d.e", "x@@y.z", "a..b@c-.d", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.1", "0001.02.3.4", "4111 1111-1111 1111",
    "+1 (017) 555-7713 and +44 20 7946 0958", "é@b.co", "1" * 5000, "1." * 3000, "a" * 3000 + "@", "+1" + " " * 3000,
])
def test_base_spans_of_odd_texts(text):
    assert pii.base_spans(text) == plain(text)


def added(text):
    (spans,) = pii._batch_spans([text], pii.Potentials())
    return [(pii.KINDS[k], text[a:b]) for a, b, k, base in spans if not base]


def test_field_follows_repeated_and_similar_tokens():
    far = " word" * 500
    assert added(f"card 4111111111111111{far} again 4111.1111.1111.1111 end") == [("card", "4111.1111.1111.1111")]
    assert added(f"call +1 (017) 555-7713{far} or 017 555 7713 now") == [("phone", "017 555 7713")]
    assert added(f"host 97.51.17.173{far} as 97-51-17-173 here") == [("ip", "97-51-17-173")]
    assert added(f"mail jane.doe@mail.example.com{far} or jane.doe@intranet please") == [("email", "jane.doe@intranet")]


def test_field_leaves_unrelated_tokens_alone():
    assert added("order 4111.1111.1111.1111 alone") == []
    assert added("card 4111111111111111 and order 1234567890123 in 2020, number 555 1234") == []
    assert added("call +1 (017) 555-7713 or see 20240131 and 1234-5678") == []


@pytest.mark.parametrize("token, kind", [("555 123 4567", "phone"), ("jane@intranet", "email"), ("97-51-17-173", "phone"), ("4111/1111/1111/1112/9", "card")])
def test_repeated_tokens_need_no_unrelated_base_span(token, kind):
    text = f"first {token}{' word' * 200} then {token} end"
    alone = added(text)
    assert alone == added(f"mail a.b@example.org now{' word' * 200} {text}")
    assert alone == [(kind, token)] * 2
    assert added(f"first {token}{' word' * 200}") == []


def test_a_number_repeated_many_times():
    text = "4111111111111111 " + "x 4111/1111/1111/1111 " * 3000
    assert len(added(text)) == 3000


def test_query_digests(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op1_skip_chain_pii"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r.doc_id])
        named = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in base)
        assert r.base_sha256 == hashlib.sha256(named.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in base) for k in range(4)]
        assert set(named.split(",")) - {""} <= set(r.spans.split(","))


def test_redact_nulls_empty_and_clashing(spark):
    docs = spark.createDataFrame([(1, "mail a@b.co now", "x"), (2, None, "y"), (3, "", "z")], "doc_id long, text string, base string")
    got = {r.doc_id: (r.text, r.base) for r in pii.redact(docs).collect()}
    assert got == {1: ("mail [email] now", "x"), 2: (None, "y"), 3: ("", "z")}
    assert pii.find_personal_data(docs.where("false")).count() == 0
