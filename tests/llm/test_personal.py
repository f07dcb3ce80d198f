import re
import time

import pytest

from jsonstrata.llm.personal import BASE, KINDS, find_personal
from samples import documents

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

TEXTS = [
    (1, "é😀 mail a.b+c@x-y.example.com, a@b.c%d@e.f and x@y no@dot. ..z@q.r-"),
    (2, "1.2.3.4 1.2.3.400.5.6.7 256.1.1.1 0001.02.003.255 1.2.3.4.5.6.7.8 1.2.3"),
    (3, "4111 1111 1111 1111, 4111-1111-1111-1112, 41111111111111111111, 4111  1111, 0000000000000000 1 2"),
    (4, "+1 (743) 555-3824 +12 +1-2 +49 30 1234567. +1234567890123456 ++33 1 23 45 67 89)"),
    (5, None),
    (6, ""),
    (7, "nothing here"),
    (8, "IBAN GB82 WEST 1234 5698 7654 32 xGB82WEST12345698765432 DE89370400440532013000 GB82WEST12345698765433"),
    (9, "social security 123-45-6789; and far away from any such word comes another one, see: 123-45-6788 000-12-3456"),
    (10, "card: 4111 1111 1111 1111"),
    (10, "card: 4111 1111 1111 1111"),
    (None, "a@b.de"),
    (11, " ".join(f"10.0.{i % 300}.{i % 7} u{i}@h.org" for i in range(1000))),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind, match):
    digits = re.sub(r"[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 8 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k in BASE for m in re.finditer(PATTERNS[k], text or "") if holds(k, m[0])]


def test_base_spans_equal_brute_force(spark):
    got = [(r["doc_id"], [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] in BASE]) for r in find_personal(documents(spark, TEXTS)).collect()]
    assert sorted(got, key=repr) == sorted(((i, brute(t)) for i, t in TEXTS), key=repr)


def test_added_kinds_and_scores(spark):
    found = {r["doc_id"]: r["spans"] for r in find_personal(documents(spark, TEXTS)).collect()}
    assert [(s["kind"], TEXTS[7][1][s["start"] : s["end"]], s["score"]) for s in found[8]] == [
        ("iban", "GB82 WEST 1234 5698 7654 32", 95),
        ("iban", "DE89370400440532013000", 60),
    ]
    # A number of that form counts only beside a word that says what it is.
    assert [(s["kind"], s["start"], s["score"]) for s in found[9]] == [("ssn", 16, 55)]
    plain = {s["score"] for s in found[3] if s["kind"] == "card"}
    assert plain == {50} and {s["score"] for s in found[10]} == {85}
    sure = {r["doc_id"]: r["spans"] for r in find_personal(documents(spark, TEXTS), least=80).collect()}
    assert [s["kind"] for s in sure[10]] == ["card"] and sure[3] == []


@pytest.mark.parametrize("text", ["9" * 300_000, "a" * 300_000, "9." * 150_000, "+1" + " " * 300_000, "a@" * 150_000, "AA11" * 75_000, "1 " * 150_000])
def test_long_runs_take_linear_time(spark, text):
    start = time.monotonic()
    found = find_personal(documents(spark, [(1, text)])).first()["spans"]
    assert time.monotonic() - start < 20
    assert len([s for s in found if s["kind"] == "ip"]) == (37_500 if text.startswith("9.") else 0)


def test_empty_table(spark):
    found = find_personal(documents(spark, TEXTS).where("false"))
    assert found.columns == ["doc_id", "spans"] and found.count() == 0
    assert [k.name for k in KINDS[: len(BASE)]] == list(BASE)
