"""Personal data beside the plain patterns, known numbers, and texts made to hang a pattern."""

import hashlib
import random
import re
import time

from llm_cases import SF, awkward, nothing  # noqa: F401
from tidewright.llm.pii import base_spans, find_personal_data, luhn, masked, mod97, spans_of
from tidewright.llm.queries import QUERIES

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(digits[::-1])) % 10 == 0


def plain_base(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 12 <= len(digits) <= 19 and plain_luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                found.append((kind, *m.span()))
    return found


def text_of(spans):
    order = list(PLAIN)
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], order.index(s[0]))))


def test_base_beside_plain_patterns():
    rng = random.Random(4)
    parts = ["a", "b.c", "@", "@x.de", ".", "-", " ", "+", "+1", "(", ")", "255", "256.1", "1.2.3.4", "4111111111111111",
             "4111 1111 1111 1111", "é", "日", "+1 (310) 555-4510", "\n", "x%y_z", "..", "0001.2.3.4"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert sorted(base_spans(text)) == sorted(plain_base(text)), text


def test_checks():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert mod97("DE89370400440532013000") and mod97("GB82WEST12345698765432") and not mod97("DE89370400440532013001")


def kinds(text):
    return [("email", "ip", "card", "phone", "iban", "ssn", "secret")[s[1]] + ":" + text[s[0]:s[2]] for s in spans_of(text)]


def test_spans_the_base_forms_miss():
    assert kinds("a 4111111111111111 5500005555555559 b") == ["card:4111111111111111", "card:5500005555555559"]
    assert kinds("call +1 (826) 555-4081 190.137.223.204") == ["phone:+1 (826) 555-4081", "ip:190.137.223.204"]
    assert kinds("+1 (826) 555-4081 4111111111111111") == ["phone:+1 (826) 555-4081", "card:4111111111111111"]
    assert kinds("IBAN DE89 3704 0044 0532 0130 00 and") == ["iban:DE89 3704 0044 0532 0130 00"]
    assert kinds("IBAN DE89 3704 0044 0532 0130 01 and") == []
    assert kinds("SSN: 123-45-6789") == ["ssn:123-45-6789"] and kinds("part 123-45-6789") == []
    assert kinds("SSN: 000-45-6789") == []
    assert kinds("tel. 310-555-4510") == ["phone:310-555-4510"] and kinds("sum 310-555-4510") == []
    token = "2321bac4d15ec8f90433955bf9d3cf61da5bdd1e"
    assert kinds(f'token = "{token}"') == [f"secret:{token}"] and kinds(f"commit {token}") == []
    assert kinds("GNU General Public License, version 3. CC BY-NC 4.0. In 2024, 10,000 people.") == []


def test_context_moves_the_score():
    score = lambda text: spans_of(text, 0)[0][3]
    assert score("server 10.0.0.1") > score("xxxxxx 10.0.0.1") > score("version 10.0.0.1")


def test_query_beside_plain_patterns(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op12_pii"](spark, SF).collect()
    assert len(rows) == len(docs) and sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 0
    for r in rows:
        base = plain_base(docs[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == b[0] for b in base) for k in PLAIN]
        assert r.base_sha256 == hashlib.sha256(text_of(base).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(spans)
        starts = [int(s.split(":")[1]) for s in spans]
        assert starts == sorted(starts)
        if not re.search("[0-9@]", docs[r.doc_id]):
            assert spans == []


def test_planted_secrets_are_found_and_masked(spark):
    rows = masked(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert not any(re.search(r'(?i)token = "[0-9a-f]{40}', r.text or "") for r in rows)
    df = spark.createDataFrame([(1, "Ünï a.b@c.de 🙂 4111111111111111."), (2, None), (3, "plain")], "k int, text string")
    assert [tuple(r) for r in masked(df).orderBy("k").collect()] == [(1, "Ünï <email> 🙂 <card>."), (2, None), (3, "plain")]


def test_long_texts_take_time_by_length():
    start = time.perf_counter()
    for text in ("1" * 300_000, "a" * 300_000 + "@", "@a" * 150_000, "1." * 150_000, "+1 " * 100_000, "1 " * 150_000, "a1" * 150_000,
                 "+" + "1 (" * 100_000, "123-" * 75_000, "DE12 " * 60_000, "4111111111111111 " * 20_000):
        spans_of(text)
    assert time.perf_counter() - start < 20


def test_awkward_rows(spark, awkward, nothing):
    found = find_personal_data(awkward.withColumn("spans", awkward.bucket)).collect()
    assert len(found) == awkward.count() and all(r.spans == [] for r in found)
    assert found[0].asDict().keys() == {"doc_id", "text", "kept", "bucket", "spans"}
    assert find_personal_data(nothing).count() == 0
    assert masked(nothing).columns == nothing.columns and masked(awkward).count() == awkward.count()
