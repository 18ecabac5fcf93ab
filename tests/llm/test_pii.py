import random

import brute
from hypothesis import given, settings
from hypothesis import strategies as st
from periodload.llm import pii

PARTS = ["a@b.co", "x.y+z@mail-1.example.org", "@", "a@", "@b.c", "1.2.3.4", "256.1.1.1", "1.2.3", "10.0.0.1.5.6.7.8", "+1 (487) 555-7209", "+44 20 7946 0958", "+1", "+", "4111 1111 1111 1111",
         "4539-1488-0343-6467", "12345678901234567890", " ", "é", "日", "-", ".", "7", "word", "\n", "a@b@c.de", "00000000000000", "https://", "account no: ", "IBAN ", "GB82 WEST 1234 5698 7654 32"]


def base(text):
    spans = pii.find_spans(text, pii._automaton()) if text else []
    own = [s for s in spans if s[1] in pii.BASE_KINDS]
    counts = tuple(sum(s[1] == k for s in own) for k in pii.BASE_KINDS)
    return counts, ",".join(f"{k}:{a}:{b}" for a, k, b in own)


def same(text):
    import hashlib

    counts, joined = base(text)
    assert (counts, hashlib.sha256(joined.encode()).hexdigest()) == brute.personal_data(text), text


def test_base_kinds_equal_the_patterns():
    rnd = random.Random(4)
    for _ in range(20_000):
        same("".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 8))))


@settings(max_examples=300, deadline=None)
@given(st.text("0123456789.+-() @aé", max_size=40))
def test_base_kinds_equal_the_patterns_on_any_text(text):
    same(text)


def test_added_kinds():
    spans = lambda t: {(k, t[a:b]) for a, k, b in pii.find_spans(t, pii._automaton())}
    assert ("iban", "GB82 WEST 1234 5698 7654 32") in spans("pay GB82 WEST 1234 5698 7654 32 now")
    assert not any(k == "iban" for k, _ in spans("pay GB83 WEST 1234 5698 7654 32 now"))
    assert ("account", "AB-123456") in spans("Account no: AB-123456, thanks")
    assert spans("the accountant had 123456 reasons") == set()
    assert ("login", "me:secret") in spans("see https://me:secret@host/x")
    assert spans("see https://host:80/x@y") == set()


def test_digest_and_redaction(spark):
    docs = [(1, "write to a@b.co or +1 (487) 555-7209."), (2, None), (3, ""), (4, "plain"), (4, "plain"), (None, "1.2.3.4"), (5, "x " * 50_000 + "a@b.co")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "7 as pii", "'s' as spans")
    out = {(r["doc_id"], r["n_email"], r["n_phone"], r["n_ip"]): r["spans"] for r in pii.personal_data_digest(pii.find_personal_data(df)).collect()}
    assert out[1, 1, 1, 0] == "email:9:15,phone:19:36"
    assert out[2, 0, 0, 0] == out[3, 0, 0, 0] == out[4, 0, 0, 0] == ""
    assert out[None, 0, 0, 1] == "ip:0:7" and out[5, 1, 0, 0] == "email:100000:100006"
    red = pii.redact(df)
    assert red.columns == df.columns
    texts = {r["doc_id"]: r["text"] for r in red.collect()}
    assert texts[1] == "write to [EMAIL] or [PHONE]." and texts[2] is None and texts[3] == "" and texts[None] == "[IP]"
    assert pii.personal_data_digest(pii.find_personal_data(df.limit(0))).collect() == []


def test_time_grows_in_proportion_on_repeats_of_each_anchor():
    import time

    automaton = pii._automaton()
    for part in [*pii.SCHEMES, *pii.CUES, "@", "+1", "+1(", "1", "1.", "1 ", "a@b.", "a@", "GB82", "id: 1", "mailto:a:"]:
        begin = time.process_time()
        pii.find_spans(part * (400_000 // len(part)), automaton)
        assert time.process_time() - begin < 8, part


def test_a_scheme_within_the_stretch_of_another():
    spans = lambda t: {(k, t[a:b]) for a, k, b in pii.find_spans(t, pii._automaton())}
    assert ("login", "mailto:me:pw") in spans("mailto:mailto:me:pw@host")
    assert spans("mailto:mailto:") == set()
