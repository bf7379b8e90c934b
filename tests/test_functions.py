import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from ledgerstone import functions as fn


def test_trimmed(values):
    assert values(fn.trimmed, ["  hello  ", "", None, "  "]) == ["hello", None, None, None]


def test_email(values):
    got = values(fn.mask_email, ["Jane.Doe@Example.com", "not-an-email", "a@b@c.com", None])
    assert got == ["j***@example.com", None, None, None]


def test_phone(values):
    assert values(fn.mask_phone, ["0412345678", "04-1234-5678", "1"]) == ["04XX XXX XXX", "04XX XXX XXX", None]


def test_identifier(values):
    assert values(fn.mask_identifier, ["123456789", "123 456 789", "ab"]) == ["********789", "********789", None]


def test_card(values):
    assert values(fn.mask_card, ["4111111111111234", "123"]) == ["**** **** **** 1234", None]


AMOUNTS = {
    "-50": "NEGATIVE", "0": "$0-$999", "999": "$0-$999", "1000": "$1K-$4,999", "4999": "$1K-$4,999",
    "5000": "$5K-$9,999", "9999": "$5K-$9,999", "10000": "$10K-$49,999", "49999": "$10K-$49,999",
    "50000": "$50K-$99,999", "99999": "$50K-$99,999", "100000": "$100K-$499,999", "499999": "$100K-$499,999",
    "500000": "$500K-$999,999", "999999": "$500K-$999,999", "1000000": "$1M+", "abc": None, "": None, "$1,000": "$1K-$4,999",
}


def test_amount_band(values):
    assert values(fn.amount_band, list(AMOUNTS)) == list(AMOUNTS.values())


def test_age_band(values):
    assert values(fn.age_band, [None, 17, 18, 24, 25, 64, 65], "int") == [
        "UNKNOWN", "UNDER_18", "18_24", "18_24", "25_34", "55_64", "65_PLUS",
    ]


@pytest.mark.parametrize("key", [b"k", b"x" * 64, b"long" * 40])
def test_name_token_is_hmac(values, key):
    names = ["Ann  Lee", " ann lee ", "ANN\tLEE", "Zoë Ünal", None]
    want = [None if n is None else hmac.new(key, " ".join(n.lower().split()).encode(), hashlib.sha256).hexdigest() for n in names]
    assert values(lambda c: fn.name_token(c, key), names) == want
    assert want[0] == want[1] == want[2]


def test_scrub(values):
    got = values(
        fn.scrub_pii,
        ["mail support@example.com now", "call 0412 345 678", "tax 123 456 782", "loan 650000.00", "0412345678 0412345679", "+61 412 345 678"],
    )
    assert got == [
        "mail [EMAIL] now", "call [AU_MOBILE]", "tax [TFN_LIKE]", "loan 650000.00", "[AU_MOBILE] [AU_MOBILE]", "[AU_MOBILE]",
    ]


def test_handling(spark):
    frame = spark.createDataFrame([("a@b.co", "x", "1500", "y")], "mail string, name string, amount string, gone string")
    row = fn.apply_handling(
        frame, {"mail": "mask_email", "name": "tokenise", "amount": "range_bucket", "gone": "remove"}, b"k"
    ).first()
    assert row.asDict().keys() == {"mail", "name", "amount"} and row.mail == "a***@b.co" and row.amount == "$1K-$4,999"
    with pytest.raises(ValueError):
        fn.apply_handling(frame, {"name": "tokenise"})
    with pytest.raises(ValueError):
        fn.apply_handling(frame, {"name": "blur"})


def test_bad_input_gives_null(values):
    assert values(fn.safe_date, ["2024-02-30", "x", "2024-02-29"])[:2] == [None, None]
    assert values(fn.safe_int, ["12", "1x"]) == [12, None]
    assert values(fn.safe_timestamp, ["nope"]) == [None]
    assert values(lambda c: fn.safe_bool(c), ["true", "maybe"]) == [True, None]
    assert values(lambda c: F.lit(1), ["a"]) == [1]
