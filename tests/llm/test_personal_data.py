"""Spans of personal data against matches found one by one in Python."""

import hashlib
import re

import pytest

from moontally.llm import personal_data as P
from moontally.llm.queries import op6_personal_data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed([int(c) for c in number])):
        total += digit if place % 2 == 0 else sum(divmod(2 * digit, 10))
    return total % 10 == 0


def passes(kind: str, match: str) -> bool:
    number = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 14 <= len(number) <= 19 and luhn(number)
    if kind == "phone":
        return 10 <= len(number) <= 15
    return True


def brute(text: str) -> list[tuple[int, int, str, int]]:
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        out += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text) if passes(kind, m.group())]
    return sorted(out)


def added(text: str) -> list[tuple[int, int, str, int]]:
    """Spans of the added kinds: a checksum or a context word confirms them; none overlaps a base span."""
    base, out = brute(text), []
    for rank, kind in enumerate(P.KINDS):
        if kind.base:
            continue
        found = list(re.finditer(kind.pattern, text))
        cuts = [0, *(x for m in found for x in m.span()), len(text)]
        for i, m in enumerate(found):
            before, after = text[cuts[2 * i] : m.start()][-P.CONTEXT :], text[m.end() : cuts[2 * i + 3]][: P.CONTEXT]
            score = kind.score + 0.3 * bool(re.search(kind.context, f"{before}\n{after}".lower()))
            code = m.group().replace(" ", "")
            if kind.name == "iban":
                number = int("".join(str(int(c, 36)) for c in code[4:] + code[:4]))
                score = score if 15 <= len(code) <= 34 and number % 97 == 1 else 0
            if score >= P.THRESHOLD and not any(a < m.end() and m.start() < b for a, _, _, b in base):
                out.append((m.start(), rank, kind.name, m.end()))
    return out


def all_listed(text: str) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(brute(text) + added(text)))


def listed(text: str) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in brute(text))


TEXTS = [
    None, "", " ", "plain", "a@b.c", "x.y+z@mail-1.example.com. @@ a@b a@b.c@d.e", "é🙂 a@b.co 🙂 1.2.3.4",
    "1.2.3.4.5.6.7.8.9", "256.1.1.1 000255.0.0.1 1.2.3", "1..2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112",
    "x4111111111111111y +49 (30) 1234-5678 +1 2", "+1234567890123456", "++12 34567890 .", "+12345678901",
    "8.8.8.8@x.y", "a_b@c.d_e@f.g", "0" * 5000, "a" * 5000 + "@b.c", "1.1.1.1 " * 700, "5500 0000 0000 0004 5500 0000 0000 0004",
    "pay DE89 3704 0044 0532 0130 00 to GB82WEST12345698765432 or DE88 3704 0044 0532 0130 00",
    "call 555-123-4567 now", "number 555-123-4567 now", "  a@b.c \x00 1.2.3.4",
]


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, text, "clash") for i, text in enumerate(TEXTS)] + [(4, TEXTS[4], "clash")]
    return spark.createDataFrame(rows, "doc_id long, text string, _gaps string")


def test_base_spans_equal_matches_found_one_by_one(frame):
    rows = P.spans(frame, "doc_id", "text").select("doc_id", P.listed("base").alias("base"), P.listed("spans").alias("spans")).collect()
    assert len(rows) == len(TEXTS) + 1
    for row in rows:
        assert row.base == listed(TEXTS[row.doc_id] or ""), TEXTS[row.doc_id][:80]
        assert row.spans == all_listed(TEXTS[row.doc_id] or ""), TEXTS[row.doc_id][:80]


def test_added_kinds_need_checksum_or_context(frame):
    rows = {r.doc_id: r.spans for r in P.spans(frame, "doc_id", "text").select("doc_id", P.listed("spans").alias("spans")).collect()}
    codes = [x for x in rows[22].split(",") if x.startswith("iban")]
    assert codes == ["iban:4:31", "iban:35:57"]
    assert rows[23] == "local_phone:5:17" and rows[24] == ""


def test_context_raises_the_score(spark):
    frame = spark.createDataFrame([(1, "a@b.cd"), (2, "mail me: a@b.cd")], "doc_id long, text string")
    scores = {r.doc_id: r.base[0].score for r in P.spans(frame, "doc_id", "text").collect()}
    assert scores[2] > scores[1]


def test_redaction_keeps_columns_and_the_rest_of_the_text(frame):
    rows = P.redact(frame, "text").collect()
    assert frame.columns == P.redact(frame, "text").columns
    by_id = {r.doc_id: r.text for r in rows}
    assert by_id[0] is None and by_id[1] == "" and by_id[3] == "plain"
    assert by_id[6] == "é🙂 [EMAIL] 🙂 [IP]" and by_id[11] == TEXTS[11] and by_id[10] == "[CARD]"
    assert {r._gaps for r in rows} == {"clash"}


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert P.spans(frame, "doc_id", "text").count() == 0 and P.redact(frame, "text").count() == 0


def test_query_on_the_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op6_personal_data(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        wanted = brute(texts[row.doc_id] or "")
        assert row.base_sha256 == hashlib.sha256(listed(texts[row.doc_id] or "").encode()).hexdigest()
        assert row.spans == all_listed(texts[row.doc_id] or "")
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(x[2] == k for x in wanted) for k in PATTERNS]
