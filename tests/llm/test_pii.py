import hashlib
import random
import re

from brute import HARD, hard_documents, no_documents

from temblor.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def plain_base(text):
    return [
        (rank, m.start(), m.end())
        for rank, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text)
        if holds(kind, m.group())
    ]


def test_base_spans_equal_the_patterns():
    r = random.Random(8)
    bits = ["a", "B.", "@", "x-y", ".", "-", " ", "+", "1", "23", "255", "256", "4111 1111 1111 1111", "4111111111111111", "(", ")", "\n", "٣", "é", "00012.1.2.3", "+1 (555) 555-0100"]
    for _ in range(4000):
        text = "".join(r.choice(bits) for _ in range(r.randint(0, 14)))
        assert sorted(pii.base_spans(text)) == plain_base(text), repr(text)


def corpus():
    """Phones follow 'call us at'; some lack the plus sign that the base pattern needs."""
    r = random.Random(4)
    rows = []
    for i in range(60):
        number = f"{r.randint(200, 999)}-{r.randint(200, 999)}-{r.randint(1000, 9999)}"
        plus = i % 4 != 0
        rows.append((i, f"w{i} please call us at {'+1-' if plus else ''}{number} today, order {r.randint(10**8, 10**9)} is ready"))
    return rows


def test_a_context_finds_what_the_patterns_miss(spark):
    rows = corpus()
    out = {r.doc_id: r for r in pii.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        number = re.search(r"at (\S+) today", text)
        start, end = number.span(1)
        assert out[i].spans == f"phone:{start}:{end}"  # the order number is no phone
        assert out[i].n_phone == int(i % 4 != 0)


def test_copies_prove_nothing(spark):
    text = "w please call us at +1-555-555-0100 today or call us at 555-555-0199 today"
    rows = [(i, text) for i in range(50)]
    out = pii.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.spans for r in out.collect()} == {f"phone:{text.index('+')}:{text.index('+') + 15}"}


def test_redaction(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "s", i % 3) for i, r in enumerate(rows)], "doc_id long, text string, source string, spans long")
    out = pii.redact(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert len(texts) == 60 and all("at <PHONE> today" in t for t in texts.values())
    assert pii.redacted_text("ab 1.2.3.4 cd", [(1, 3, 10), (3, 5, 12)]) == "ab <IP>d"


def test_hard_rows(spark):
    out = pii.scan(hard_documents(spark)).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in HARD)
    texts = dict((r[0], r[1]) for r in HARD)
    for row in out:
        base = plain_base(texts[row.doc_id] or "")
        assert row.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert row.spans == pii.joined(base)
    assert pii.scan(no_documents(spark)).count() == 0
    docs = hard_documents(spark)
    assert sorted(str(r.doc_id) for r in pii.redact(docs).collect()) == sorted(str(r[0]) for r in HARD)
    assert pii.redact(no_documents(spark)).count() == 0


def test_numbers_written_in_groups(spark):
    r = random.Random(6)
    rows = []
    for i in range(40):
        area, middle, last = r.randint(20, 29), r.randint(1000, 9999), r.randint(1000, 9999)
        number = [f"+44 {area} {middle} {last}", f"0{area} {middle} {last}", f"+44 {area} {middle} {last}", f"+44-{area}-{middle}-{last}"][i % 4]
        rows.append((i, f"w{i} tel {number} today, {i} of 40"))
    rows.append((90, "tel (020) 7946 0958 today"))
    texts = dict(rows)
    out = {x.doc_id: x.spans for x in pii.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in texts.items():
        start, end = re.search(r"tel \(?(.+) today", text).span(1)
        assert out[i] == f"phone:{start}:{end}", text
    redacted = {x.doc_id: x.text for x in pii.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(not re.search("[0-9]{4}", t) for t in redacted.values())
    # a run that is too long for one identifier still gives its parts; a full stop or line ends a run
    values = lambda text: [x[3] for x in pii.occurrences(text, pii.base_spans(text))]
    assert values("a 12 34. 5678901 b") == ["12", "34", "5678901"]
    assert values("a 123 4567\n890 1234 b") == ["123 4567", "890 1234"]
    assert values("1 2 3") == ["1", "2", "3"]
    assert "".join(values("1 " * 500)).replace(" ", "") == "1" * 500


def test_rounds_go_on_until_nothing_is_new(spark):
    """Each context shares most of its numbers with the one before; the first has seeds."""
    sizes, texts, number = [200, 80, 32, 12, 3], [], 0
    for step, size in enumerate(sizes):
        for _ in range(size):
            number += 1
            value = f"+1{number:010d}" if step == 0 else f"7{number:09d}"
            texts += [f"ctx{c} {value}" for c in {max(step - 1, 0), min(step, 3)}]
    rows = list(enumerate(texts))
    out = {x.doc_id: x.spans for x in pii.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[i] == f"phone:5:{len(t)}" for i, t in rows)


def test_contexts_reach_to_their_real_ends():
    blanks, word = " " * 1000, "w" * 10_000
    text = f"tel:{blanks}5550100 {word} 5550101"
    found = {v: p for _, _, _, v, p in pii.occurrences(text, [])}
    assert found["5550100"][0] == "1|tel:" and found["5550101"][0].startswith("1|#") and "2|5550100 #" in found["5550101"][1]
    long = "x" * 5000 + "7"
    assert [text[s:e] for _, s, e, _, _ in pii.occurrences(f"id {long}", []) for text in [f"id {long}"]] == [long]


def test_contexts_take_linear_time():
    for text in ("a" * 2_000_000, "(" * 500_000 + "5550100", " " * 500_000 + "5550100", "1 " * 200_000, "1" * 1_000_000, "@" * 300_000, "w" * 500_000 + " 1 2 3"):
        pii.occurrences(text, pii.base_spans(text))
