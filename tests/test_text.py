"""Rule goldens, rule order, and both corpora against Python's ``re``."""

import random
import re

import pytest
from pyspark.sql import functions as F

from logloom.functions import text
from logloom.functions.rules import RULES_V1, RULES_V2
from logloom.plans import fixtures as fx


def plain_form(message, ruleset=RULES_V1):
    for rule in ruleset.rules:
        message = re.sub(rule.pattern, rule.token, message)
    return re.sub(r"\s+", " ", message).strip()


def plain_clean(message):
    return message.rsplit(text.BOM, 1)[-1].strip()


GOLDEN = [
    ("from 02:00:5e:10:00:42 up", "from <MAC> up"),
    ("at 2024-08-21T02:42:49+00:00 done", "at <TS> done"),
    ("at 2024-08-21 02:42:49.123Z done", "at <TS> done"),
    ("am 18.08.24 17:43:14 und 18.08.2024", "am <DATE> und <DATE>"),
    ("peer 10.11.12.5 seen", "peer <DATE>.<N> seen"),
    ("peer 192.168.178.20 seen", "peer <IP> seen"),
    ("at 17:43 or 17:43:14", "at <TS> or <TS>"),
    ("via fe80::1234 and 2001:db8:1:2:3:4:5:6", "via <IP6> and <IP6>"),
    ("log /var/log/run/out.txt", "log <PATH>"),
    ("get http://a/b now", "get http:/<PATH> now"),
    ("sum deadbeef01234567 ok", "sum <HASH> ok"),
    ("1234567890123456", "<HASH>"),
    ("5.322 GHz, 100 Mbit/s, 7 %, 3 Min.", "<QTY>, <QTY>, <N> %, <N> Min."),
    ("version v22.1 and 1.2.3.4.5", "version <VER> and <IP>.<N>"),
    ("token a1b2c3d4x 5-GHz-Band", "token <ID> <N>-GHz-Band"),
    ("x\t 42 \n y", "x <N> y"),
]


@pytest.fixture(scope="module")
def golden(spark):
    rows = spark.createDataFrame([(i, m) for i, (m, _) in enumerate(GOLDEN)], "i int, m string")
    return {r.i: r.f for r in rows.select("i", text.normalize_form("m").alias("f")).collect()}


@pytest.mark.parametrize("i", range(len(GOLDEN)))
def test_golden(golden, i):
    message, want = GOLDEN[i]
    assert golden[i] == want == plain_form(message)


def random_messages(n, seed=7):
    rng = random.Random(seed)
    pieces = ["12", "3.4", "ab", "deadbeef", ":", "::", "/", "-", "_", ".", " ", "\t", "GB", "MB", "%", "min", "v", "2024-01-02",
              "T", "03:04:05", "Z", "+01:00", "10.1.2.3", "fe80", "x", "0", "99999999", "é", "ß", "٣", " ", "\x1c", "(", ",", "h", "s"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 14))) for _ in range(n)]


@pytest.mark.parametrize("ruleset", [RULES_V1, RULES_V2], ids=["v1", "v2"])
def test_random_text_equals_python(spark, ruleset):
    messages = random_messages(4000)
    rows = spark.createDataFrame(list(enumerate(messages)), "i int, m string")
    got = {r.i: r.f for r in rows.select("i", text.normalize_form("m", ruleset).alias("f")).collect()}
    bad = [(m, got[i], plain_form(m, ruleset)) for i, m in enumerate(messages) if got[i] != plain_form(m, ruleset)]
    assert not bad, bad[:3]


def test_whole_documents_equal_python(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").select("text", text.normalize_form(text.clean_bom("text")).alias("f"))
    for row in docs.collect():
        assert row.f == plain_form(plain_clean(row.text))


def test_rule_order_matters(spark):
    rows = spark.createDataFrame([("10.11.12.5",)], "m string")
    v1, v2 = rows.select(text.normalize_form("m"), text.normalize_form("m", RULES_V2)).first()
    assert (v1, v2) == ("<DATE>.<N>", "<IP>")


@pytest.mark.parametrize("raw, want", [
    ("a" + text.BOM + "b" + text.BOM + " c ", "c"), ("  x 　", "x"), ("\x1cx\x1f", "x"), (text.BOM, ""), ("plain", "plain")])
def test_clean(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "m string").select(text.clean_bom("m")).first()[0] == want == plain_clean(raw)


def test_raw_message_is_not_kept(spark, sf_dir):
    assert "message" not in fx.fingerprinted(spark, sf_dir).columns


def test_null_parts_keep_the_row(spark):
    rows = spark.createDataFrame([(1, None, None, None)], "id int, host string, program string, message string")
    out = text.with_fingerprint(rows).first()
    assert out.fingerprint == "||" and out.bom_missing is False


def test_forms_are_computed_once(spark, sf_dir):
    fp = fx.fingerprinted(spark, sf_dir)
    joined = fp.join(fp.groupBy("fingerprint").agg(F.count("*").alias("n")), "fingerprint")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(concat_ws" not in plan
