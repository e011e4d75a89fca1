"""Secrets and account numbers: recall on planted ones, few false ones."""
import random
import re
import string

from pitwall.llm import pii


def kinds(text):
    return [(k, text[s:e]) for k, s, e, _ in pii.find(text)]


def test_planted_secrets_are_found():
    rnd = random.Random(4)
    found = 0
    for _ in range(300):
        value = "".join(rnd.choice("0123456789abcdef") for _ in range(40)) if rnd.random() < 0.5 else "".join(
            rnd.choice(string.ascii_letters + string.digits + "+/") for _ in range(rnd.randint(20, 44)))
        word = rnd.choice(["token", "API_KEY", "password", "client_secret", "access-key", "Secrets"])
        text = f"some words {word}{rnd.choice([' = ', '=', ': '])}{rnd.choice(['', chr(34)])}{value}{chr(34)} and more"
        found += ("secret", value) in [(k, v.rstrip('"')) for k, v in kinds(text)]
    assert found >= 0.97 * 300


def test_what_is_no_secret():
    for text in ("the token = the word of a text", "password: aaaaaaaaaaaaaaaaaaaaaaaa", "key = 0123456789abcdef0123456789abcdef",
                 "see https://example.org/a/very/long/path/with/many/parts", "ratio: 1234567890123456", "secretary: Konstantinopel"):
        assert "secret" not in dict(kinds(text)), text


def test_documents_with_planted_tokens(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text LIKE '%token = %'").collect()
    planted = [r for r in docs if re.search(r'token = "[0-9a-f]{40}"', r.text)]
    assert len(planted) >= 20
    assert sum("secret" in dict(kinds(r.text)) for r in planted) >= 0.9 * len(planted)


def test_accounts_have_a_listed_countrys_length():
    rnd = random.Random(5)
    wrong = 0
    for _ in range(4000):     # upper-case part codes
        code = "".join(rnd.choice(string.ascii_uppercase) for _ in range(2)) + f"{rnd.randint(0, 99):02d}" + "".join(
            rnd.choice(string.ascii_uppercase + string.digits) for _ in range(rnd.randint(12, 24)))
        wrong += "iban" in dict(kinds(f"part {code} in stock"))
    assert wrong < 0.005 * 4000
    for text in ("DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", "GB82WEST12345698765432 EUR 200", "iban DE89370400440532013000 2024-05-01"):
        assert "iban" in dict(kinds(text)), text
