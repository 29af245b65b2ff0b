from tests.llm.test_pii import spans

DE, GB, NO, BE = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "NO9386011117947", "BE68539007547034"


def test_iban_before_capitals_and_numbers(spark):
    texts = [f"{DE} Please pay", f"{DE} BIC COBADEFFXXX", f"{DE} 250 EUR", f"{DE} {DE}", f"{NO} {BE} X", f"{GB} A", f"to {GB} 7", f"{DE}X", f"{DE[:-1]} Please"]
    want = [[DE], [DE], [DE], [DE, DE], [NO, BE], [GB], [GB], [], []]
    got = [[t[int(a):int(b)] for k, a, b in (x.split(":") for x in s.split(",") if x) if k == "iban"] for t, s in zip(texts, spans(spark, texts, base=False))]
    assert got == want
