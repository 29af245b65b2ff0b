import random
import re

from pyspark.sql import functions as F

from commerce_lake.llm import pii

BASE = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def luhn(d):
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in BASE:
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                  "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def spans(spark, texts, base=True):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.find(docs).select("doc_id", pii.listed("pii_spans", pii.base_kinds() if base else None).alias("s")).collect()
    return [r.s for r in sorted(rows)]


def test_base_spans_equal_brute_force(spark):
    rnd = random.Random(4)
    parts = ["a.b", "@", "x@y.zz", ".", "-", "12", "1.2.3.4", "255.255.255.256", "00255.1.1.1", "4539578763621486", "4539 5787 6362 1486", "+1 (415) 555-0134",
             "+49", " ", " ", "é", "𝄞", "\n", "_", "%", "9", "99999999999999999999", "(", ")", "ab", "a@b@c.d", "..", "e@f."]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 14))) for _ in range(1500)] + [None, "", "1" * 20000, "a" * 20000, "x@y.z " * 3000, "+1" + " " * 5000]
    assert spans(spark, texts) == [brute(t) for t in texts]


def test_checked_and_context_kinds(spark):
    texts = ["IBAN DE89370400440532013000 here", "IBAN DE89370400440532013001 here", "card: 378282246310005", "the number 378282246310005",
             "call 415-555-0134 now", "sum 415-555-0134 now", "ssn 536-90-4399", "part 536-90-4399", "GB82 WEST 1234 5698 7654 32"]
    got = [s.split(":")[0] for s in spans(spark, texts, base=False)]
    assert got == ["iban", "", "card_short", "", "phone_local", "", "ssn", "", "iban"]


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "mail é x@y.zz, 1.2.3.4 end", 26, "k"), (2, "clean 12 text", 13, "k"), (None, None, None, None), (3, "", 0, "k"), (3, "", 0, "k")],
                                 "doc_id long, text string, n_chars long, pii string")
    out = pii.redact(docs)
    assert out.columns == docs.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[1].text == "mail é [EMAIL], [IP] end" and rows[1].n_chars == len(rows[1].text)
    assert rows[2].text == "clean 12 text" and rows[2].n_chars == 13 and rows[None].text is None
    assert out.count() == 5 and pii.redact(docs.where(F.lit(False))).count() == 0


def brute_redact(text, found):
    out, at = [], 0
    for kind, start, end in sorted(found, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def parts(listed):
    return [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in listed.split(",") if s)]


def test_redaction_and_overlaps_equal_brute_force(spark):
    rnd = random.Random(9)
    pieces = ["x@y.zz", "1.2.3.4", "+1 415 555 0134", "4539578763621486", "call 415-555-0134", " tel ", "é", "𝄞" * 300, "w " * 500, "\n", "ssn 536-90-4399", "+49 (0) 1.2.3.4 77", "."]
    texts = ["".join(rnd.choices(pieces, k=rnd.randint(0, 25))) for _ in range(200)] + ["", None, "x@y.zz", "𝄞" * 1024 + "x@y.zz" + "é" * 1018]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: parts(r.s) for r in pii.find(docs).select("doc_id", pii.listed("pii_spans").alias("s")).collect()}
    base = {k: [s for s in v if s[0] in pii.base_kinds()] for k, v in found.items()}
    for i, text in enumerate(texts):
        assert ",".join(f"{k}:{a}:{b}" for k, a, b in base[i]) == brute(text)
        # other kinds touch no base span
        assert not any(a < d and c < b for k, a, b in found[i] if k not in pii.base_kinds() for _, c, d in base[i])
    redacted = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert redacted == {i: t if t is None else brute_redact(t, found[i]) for i, t in enumerate(texts)}


def test_many_matches_in_one_text(spark):
    import time

    def timed(n):
        text = " ".join(rnd.choice(["x@y.zz", "10.20.30.40", "+1 415 555 0134", "call 415-555-0134", "4539578763621486"]) for _ in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.time()
        row = pii.find(docs).select(pii.listed("pii_spans").alias("all"), pii.listed("pii_spans", pii.base_kinds()).alias("base")).first()
        out = pii.redact(docs).first().text
        took = time.time() - start
        assert row.base == brute(text) and out == brute_redact(text, parts(row["all"])) and len(parts(row["all"])) > 0.6 * n
        return took

    rnd = random.Random(3)
    timed(2000)
    small, large = timed(20_000), timed(40_000)
    assert large < 4 * small + 5


def test_clashing_names(spark):
    names = ["pii_spans", "_row", "_text", "_spans", "row", "_m_email", "_base", "_new", "_chars"]
    docs = spark.createDataFrame([(1, "mail x@y.zz", *range(len(names)))], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    out = pii.redact(docs)
    assert out.columns == docs.columns and out.first() == (1, "mail [EMAIL]", *range(len(names)))
    found = pii.with_spans(docs)
    assert sorted(found.columns) == sorted(docs.columns) and found.first()["pii_spans"][0].kind == "email"
