"""Personal data: base spans against a plain version, added spans, the estimate of reliabilities, awkward cases."""

import hashlib
import re

import pytest
from pyspark.sql import Row

from thermopanel.llm import pii
from thermopanel.llm.queries import QUERIES

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes_luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def plain(text):
    out = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            number = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(number) <= 19 and passes_luhn(number)):
                continue
            if kind == "phone" and not 10 <= len(number) <= 15:
                continue
            out.append((m.start(), order, m.end()))
    return sorted(out)


def listed(spans):
    return ",".join(f"{list(PLAIN)[k]}:{s}:{e}" for s, k, e in spans)


CARD, AMEX = "4465758382889437", "378282246310005"
TEXTS = [
    "a@b.c@d.e a@b.c_x@d.e é😀 mail x.y+z@mail-1.example.com, ..@..a", "1.2.3.4.5.6.7.8.9 999.1.2.3.4 256.1.1.1 0000255.0.0.1 1.2.3",
    f"{CARD} x {CARD[:4]} {CARD[4:8]} {CARD[8:12]} {CARD[12:]} 4465-7583-8288-9437 4465758382889438 1{CARD}{CARD}", f"{AMEX} {AMEX}",
    "+1 (017) 555-7713 +49 30 1234567- +1234 ++1 555 123 4567+2 (((( +1 23456789012345678", "", None, " ",
    f"😀 {CARD} {CARD} tail", "x" * 5_000, "1" * 5_000 + "@", "a." * 2_000 + "@b.c", "1.1.1.1 " * 3_000, "+1((((" * 20_000, "0 " * 9_000,
    "GB82 WEST 1234 5698 7654 32 and GB82 WEST 1234 5698 7654 33", "call (212) 555-0187 or 212-555-0187x", "ssn 123-45-6789, order 000-45-6789",
    "born 1984-02-30, 31.12.1999", "Dear Mrs. Anna Müller, from Dr Karl Weiß", "write to joe.doe (at) example (dot) org", "2001:0db8:85a3:0000:0000:8a2e:0370:7334",
    "\n".join(["x@y.zz"] * 2_000),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", 0.5, [1]) for i, t in enumerate(TEXTS)] + [(1, TEXTS[1], "de", None, None), (None, TEXTS[0], "en", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, kind string, spans double, candidates array<int>").repartition(3)


def test_base_spans_equal_a_plain_version(docs, spark, sf_dir):
    for source in (docs, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        texts = {r.doc_id: r.text or "" for r in source.collect()}
        out = pii.scan_documents(source).collect()
        assert len(out) == source.count()
        for r in out:
            spans = plain(texts[r.doc_id])
            text = listed(spans)
            assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest(), r
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in spans) for j in range(4)]
            assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_time_follows_the_length(spark):
    """The plain expressions take the square of the length of such texts."""
    texts = ["x" * 400_000, "1" * 400_000 + "@", "a." * 200_000 + "@b.c", "0 " * 200_000, "a@" * 100_000, "A1" * 200_000, "f:f" * 100_000, "1.1" * 100_000]
    out = pii.scan_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.spans for r in out} == {i: "email:0:400004" if i == 2 else "" for i in range(7)} | {7: out_of(texts[7])}


def out_of(text):
    return ",".join(f"ip:{m.start()}:{m.end()}" for m in re.finditer(PLAIN["ip"], text) if all(int(p) <= 255 for p in m[0].split(".")))


def test_added_spans(docs):
    found = {(r.doc_id, r.kind, TEXTS[r.doc_id][r.start:r.end]) for r in pii.find_spans(docs.where("doc_id IS NOT NULL")).collect() if not r.base}
    assert (8, "card", CARD) in found and (3, "card", AMEX) in found
    assert (15, "iban", "GB82 WEST 1234 5698 7654 32") in found
    assert not any(value.endswith("54 33") or value == "4465758382889438" or value.startswith("000-") for _, _, value in found)
    assert (20, "email", "joe.doe (at) example (dot) org") in found
    assert (19, "name", "Mrs. Anna Müller") in found


def test_the_query_adds_only_numbers_with_right_check_digits(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op11_pii"](spark, sf_dir).collect():
        for kind, start, end in (s.split(":") for s in r.spans.split(",") if s):
            if kind == "card":
                assert passes_luhn(re.sub("[^0-9]", "", texts[r.doc_id][int(start):int(end)]))


def test_running_sums(spark):
    for n in (0, 1, pii.BLOCK - 1, pii.BLOCK, pii.BLOCK + 1, 3 * pii.BLOCK + 5):
        df = spark.createDataFrame([Row(x=[k % 7 for k in range(n)])], "x array<int>")
        assert df.select(pii.running(df.x)).first()[0] == [sum(k % 7 for k in range(i)) for i in range(n)]


def test_reliable_labelers_outweigh_others():
    code = lambda *marks: sum(m * 3 ** i for i, m in enumerate(marks))
    counts = {(0, code(2, 2, 1, 2, 1)): 500, (0, code(0, 1, 1, 0, 0)): 400, (0, code(2, 1, 1, 0, 0)): 30, (0, code(2, 0, 2, 2, 2)): 5}
    chance = pii.reliabilities(counts)
    assert chance[0, code(2, 2, 1, 2, 1)] > 0.95 and chance[0, code(0, 1, 1, 0, 0)] < 0.05
    assert chance[0, code(2, 1, 1, 0, 0)] < 0.5 and chance[0, code(2, 0, 2, 2, 2)] == 0
    assert pii.reliabilities({}) == {}


def test_redaction_keeps_columns_and_clean_texts(docs):
    out = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert pii.redact(docs).columns == docs.columns
    assert out[8].text == "😀 [card] [card] tail" and out[6].text is None and out[5].text == "" and out[9].text == TEXTS[9]
    assert out[4].text.startswith("[phone] [phone]- ") and out[8].candidates == [1]


def test_no_rows(docs):
    none = docs.limit(0)
    assert pii.scan_documents(none).count() == 0 and pii.redact(none).count() == 0
    plain_texts = docs.where("doc_id IN (5, 6, 7, 9)")
    assert [r.spans for r in pii.scan_documents(plain_texts).collect()] == [""] * 4


def test_no_python_runs(spark, sf_dir):
    plan = pii.scan_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)
