from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from claimlode.functions import text as tx


def apply(spark, rule, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    out = rows.select("i", rule(F.col("v")).alias("o")).orderBy("i").collect()
    return [row["o"] for row in out]


#: Texts and what cleaning leaves of them.
CLAIMS = {
    None: "",
    "": "",
    "   ": "",
    "plain claim": "plain claim",
    "<b>1.</b> A method": "1. A method",
    "a < b and c > d stays short": "a  d stays short",
    "open < over\na line > end": "open < over\na line > end",
    "The Present Invention is shown. Rest": "Rest",
    "THE PRESENT INVENTION spans\na line. Rest": "THE PRESENT INVENTION spans\na line. Rest",
    "x the present invention one. the present invention two. y": "x   y",
    "the present invention without end": "the present invention without end",
    "\u00a0 edges \u3000\x1f": "edges",
    "inner   space  kept": "inner   space  kept",
    "carriage <a\rb> return": "carriage  return",
    "line <a\u2028b> separator": "line  separator",
}


def test_clean_claim_follows_the_rule(spark):
    assert apply(spark, tx.clean_claim, list(CLAIMS)) == list(CLAIMS.values())


def test_blank(spark):
    values = [None, "", " \t\n", " ", "a"]
    assert apply(spark, tx.is_blank, values) == [True, True, True, True, False]


def test_id_string_keeps_null(spark):
    assert apply(spark, tx.id_string, [None, " D512345 ", "7"]) == [None, "D512345", "7"]


@pytest.mark.parametrize(
    ("rule", "expected"),
    [
        (tx.publication_digits, ["20317654321", "7000123", None, None, None, "1", None, None]),
        (tx.publication_core, ["20317654321", "7000123", "512345", "045678", "512345", None, None, "1234567"]),
        (tx.normalize_id, ["20317654321", "7000123", "512345", None, None, "1", None, "1234567"]),
    ],
)
def test_number_rules(spark, rule, expected):
    numbers = ["US20317654321A1", "US7000123B2", "USD512345S1", "USRE045678E1", "D0512345", "US1", None, "EP 1234567"]
    assert apply(spark, rule, numbers) == expected


def test_pack_and_unpack(spark):
    rows = spark.createDataFrame([(["a", "b|c", "d"],), ([],), (None,)], "v array<string>")
    packed = rows.select(tx.pack_list(F.col("v")).alias("p"))
    assert [r.p for r in packed.collect()] == ["a | b|c | d", "", None]
    back = packed.select(tx.unpack_list(F.col("p")).alias("u")).collect()
    assert [r.u for r in back] == [["a", "b|c", "d"], [], []]


def test_fmt4_rounds_like_python(spark):
    values = [1.0, 0.00015, 0.73535, 0.03125, 12345.67891, 0.0]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.o for r in rows.select(tx.fmt4(F.col("v")).alias("o")).collect()]
    assert got == [f"{v:.4f}" for v in values]


def test_found_flag_and_overlap(spark):
    rows = spark.createDataFrame(
        [(["1", "2"], "2", ["2", "3"]), (["1"], None, None), (None, "1", ["1"])],
        "ids array<string>, true_id string, other array<string>",
    )
    got = rows.select(
        tx.found_flag(F.col("ids"), F.col("true_id")).alias("f"),
        tx.overlap_size(F.col("ids"), F.col("other")).alias("n"),
    ).collect()
    assert [(r.f, r.n) for r in got] == [("Y", 1), ("N", 0), ("N", 0)]


def test_run_tag(spark):
    tag = spark.range(1).select(tx.run_tag().alias("t")).first().t
    assert re.fullmatch(r"\d{8}_\d{6}", tag)
