import random
import re

from auditloom.llm import pii as op
from tests.llm.rows import awkward_documents, empty_documents, ordered

# The base patterns as stated.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def stated(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(out)


def base(spans):
    return [(s.start, s.place, s.end) for s in spans if s.place < op.BASE_KINDS]


def random_texts():
    rng = random.Random(5)
    pieces = ["a", "B9", "@", ".", "-", "_", "%", "+", "1", "255", "256", "0", "192.168.0.1", "4539 1488 0343 6467", " ",
              "4539148803436467", "(170)", "é", "😀", "\n", "x@y.z", "a.b@c-d.e_f@g.h", "+1 ", "12-34", "..", "000", "٣", "@@"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) for _ in range(4000)]


def test_base_spans_are_the_stated_ones(spark):
    texts = random_texts() + ["1 " * 3000, "9" * 50_000, "a@" * 5000, "a.b@c.d," * 3000, "+" * 1000 + "1 " * 20_000, "x" * 200_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    found = {r.doc_id: base(r.spans) for r in op.find_pii(frame).collect()}
    for i, text in enumerate(texts):
        assert found[i] == stated(text), text[:200]
    assert sum(map(len, found.values())) > 2000


def test_awkward_rows(spark):
    docs = awkward_documents(spark)
    found = op.find_pii(docs).collect()
    assert ordered((r.doc_id, base(r.spans)) for r in found) == ordered(
        (r.doc_id, stated(r.text or "")) for r in docs.select("doc_id", "text").collect())
    assert op.find_pii(empty_documents(spark)).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r.doc_id: base(r.spans) for r in op.find_pii(docs).collect()}
    assert found == {r.doc_id: stated(r.text or "") for r in docs.collect()}


def test_account_numbers_and_context(spark):
    texts = ["IBAN: DE89 3704 0044 0532 0130 00 x", "DE89 3704 0044 0532 0130 01", "GB82WEST12345698765432",
             "card 4539148803436467", "4539148803436467"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    spans = {r.doc_id: {s.kind: s for s in r.spans} for r in op.find_pii(frame).collect()}
    assert (spans[0]["iban"].start, spans[0]["iban"].end) == (6, 33) and "iban" not in spans[1] and "iban" in spans[2]
    assert spans[3]["card"].score > spans[4]["card"].score
    assert round(spans[0]["iban"].score - spans[2]["iban"].score, 6) == op.CONTEXT_BONUS


def account_numbers(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: [texts[r.doc_id][s.start:s.end] for s in r.spans if s.kind == "iban"]
             for r in op.find_pii(frame).collect()}
    return [found[i] for i in range(len(texts))]


def test_account_numbers_beside_words(spark):
    spaced, plain = "DE89 3704 0044 0532 0130 00", "DE89370400440532013000"
    british, norse = "GB82 WEST 1234 5698 7654 32", "NO9386011117947"
    own = "ZZ" + next(f"{c:02}" for c in range(98) if int(f"12345678901{3535}{c:02}") % 97 == 1) + "12345678901"
    cases = [
        (f"{spaced} BIC COBADEFF", [spaced]), (f"{plain} EUR 500", [plain]), (f"{plain} 2024-01-02", [plain]),
        (f"{british} I paid", [british]), (f"{spaced} Bic", [spaced]), (f"{plain}\nEUR", [plain]),
        (f"{norse} {norse} {plain}", [norse, norse, plain]), (f"REF AB12 {spaced} EUR", [spaced]),
        (f"😀 {own} EUR 500", [own]), (f"{own} {own}", [own, own]), (f"{plain}EUR", []), (f"X{plain}", []),
        ("DE89 3704 0044 0532 0130 01 BIC COBADEFF", [])]
    for (text, expected), found in zip(cases, account_numbers(spark, [t for t, _ in cases])):
        assert found == expected, text


def test_context_reaches_across_earlier_proposals(spark):
    number = "4539 1488 0343 6467"
    texts = [
        f"credit card 2024: {number}", "call +49 170 1234567 or\n+49 170 7654321", f"card {'x' * 43}{number}",
        f"card {'x' * 44}{number}", f"card {'12 ' * 14}x{number}", f"card {'12a' * 20}{number}",
        f"{number} card", f"😀 card {'é1234' * 8}é{number}"]
    expected = [[True], [True, True], [True], [False], [True], [False], [False], [True]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for row in op.find_pii(frame).collect():
        spans = [s for s in row.spans if s.kind in ("card", "phone")]
        spans = [s for s in spans if texts[row.doc_id][s.start] in "+4"]
        window = [texts[row.doc_id][max(0, s.start - op.CONTEXT_CHARS):s.start].lower() for s in spans]
        got = [s.score > op.SCORES[s.kind] for s in spans]
        assert got == [bool(re.search(op.CONTEXT[s.kind], w)) for s, w in zip(spans, window)], texts[row.doc_id]
        assert got == expected[row.doc_id], texts[row.doc_id]


def test_only_built_in_functions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = op.find_pii(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
