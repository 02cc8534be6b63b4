"""Random tokens of tables without long words."""

from __future__ import annotations

import random
import string

from gleaner.llm import secret_scan

BASE64 = string.ascii_letters + string.digits + "+/"


def found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: [(s.start, s.end) for s in r.added] for r in secret_scan.scan(docs).collect()}


def test_random_tokens_without_long_words(spark):
    rng = random.Random(3)
    keys = ["".join(rng.choice(BASE64) for _ in range(40)) for _ in range(20)]
    got = found(spark, [(i, f"key {k} here") for i, k in enumerate(keys)] + [(100, "only short words"), (101, "a" * 40)])
    assert sum(got[i] == [(4, 44)] for i in range(20)) >= 18
    assert got[100] == got[101] == []


def test_a_few_long_words_change_nothing(spark):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice(BASE64) for _ in range(40))) for i in range(20)]
    words = [(100, "internationalizationsettings"), (101, "abababababababababababab")]
    got = found(spark, rows + words)
    assert got.pop(100) == got.pop(101) == [] and got == found(spark, rows)


def test_values_glued_to_names_and_paths(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for glue, size in (("aws_secret_access_key=", 40), ("AWS_SECRET_ACCESS_KEY=", 40),
                       ("https://host/download/session/", 40)):
        letters = string.ascii_letters + string.digits
        for _ in range(15):
            value = "".join(rng.choice(letters) for _ in range(size))
            want[len(rows)] = (len(glue), len(glue) + size)
            rows.append((len(rows), glue + value))
    for _ in range(15):
        digits = "%032x" % rng.getrandbits(128)
        uuid = "-".join((digits[:8], digits[8:12], digits[12:16], digits[16:20], digits[20:]))
        want[len(rows)] = (3, 39)
        rows.append((len(rows), f"id {uuid} end"))
    got = found(spark, rows)
    for first in range(0, 60, 15):
        hit = sum(any(a <= want[i][0] and want[i][1] <= b for a, b in got[i]) for i in range(first, first + 15))
        assert hit >= 12, (first, hit)


def test_padding_stays_with_its_value(spark):
    rng = random.Random(6)
    keys = ["".join(rng.choice(BASE64) for _ in range(43)) + "=" for _ in range(10)]
    got = found(spark, [(i, f"k {key} e") for i, key in enumerate(keys)])
    assert sum(got[i] == [(2, 46)] for i in range(10)) >= 8


def test_ordinary_words_beside_a_token_change_nothing(spark):
    rng = random.Random(7)
    rows = [(i, "".join(rng.choice(BASE64) for _ in range(size))) for i, size in enumerate([20, 24, 33, 40, 64, 90] * 7)]
    letters = "etaoinshrdlu"
    words = [(1000 + i, "".join(rng.choice(letters) for _ in range(rng.randint(20, 60)))) for i in range(600)]
    alone = found(spark, rows)
    assert sum(bool(spans) for spans in alone.values()) > 25
    for n in (29, 30, 600):
        got = found(spark, rows + words[:n])
        assert {i: got[i] for i in alone} == alone


def test_added_spans_against_a_plain_count_of_tokens(spark):
    """Hex and base64 values of several lengths: found where they are long; ordinary prose and names are left alone."""
    rng = random.Random(8)
    kinds = {"base64": BASE64, "upper": string.ascii_uppercase + "234567"}
    rows, planted = [], {}
    for name, alphabet in kinds.items():
        for size in (32, 48, 64):
            for _ in range(12):
                planted[len(rows)] = (name, size)
                rows.append((len(rows), "say " + "".join(rng.choice(alphabet) for _ in range(size)) + " end"))
    prose = ["internationalization of characteristics and misunderstandings", "com.example.service.configuration.Loader",
             "a_very_long_function_name_with_many_words", "https://example.org/path/to/some/interesting/article"]
    rows += [(1000 + i, prose[i % 4]) for i in range(40)]
    got = found(spark, rows)
    assert not any(got[1000 + i] for i in range(40))
    for name in kinds:
        for size in (48, 64):
            hit = sum(got[i] == [(4, 4 + size)] for i, p in planted.items() if p == (name, size))
            assert hit >= 10, (name, size, hit)
