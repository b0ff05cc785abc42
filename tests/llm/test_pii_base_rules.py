"""The base rules of op8 against plain patterns."""

import random
import re

from pyspark.sql import functions as F

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+){3}",
    "card": r"[0-9](?:[ -]?[0-9])+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or "", re.ASCII):
            digits = re.sub("[^0-9]", "", m.group())
            good = (kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")))
                    or (kind == "card" and 16 <= len(digits) <= 19 and _luhn(digits))
                    or (kind == "phone" and 8 <= len(digits) <= 15))
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans_match_plain_patterns(spark):
    from dimforge.llm.op8_pii import base_spans, spans_text

    rng = random.Random(8)
    texts = ["ping 10.0.0.1", "192.168.0.1 and 127.0.0.1", "0.0.0.0", "00.000.0.01", "1.2.3.256 0.0.0.999", "0255.0256.1.1", "1.2.3.4.0.0.0.0",
             "000000000000000000000.0.0.255", "card 4111 1111 1111 1111", "a.b@c.d.e", "+1 (555) 123-4567", None, ""]
    texts += [".".join(str(rng.choice([0, 0, 1, 9, 10, 99, 100, 199, 200, 249, 250, 255, 256, 260, 300, 999])) for _ in range(4)) for _ in range(150)]
    texts += ["".join(rng.choice("0001259.....+-@ ab()é") for _ in range(rng.randrange(60))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: r.s for r in rows.select("i", spans_text(base_spans(F.coalesce("text", F.lit("")))).alias("s")).collect()}
    assert {i: s for i, s in got.items() if s != plain_spans(texts[i])} == {}
    assert got[0] == "ip:5:13" and got[2] == "ip:0:7"


def test_zero_parts_are_redacted_and_scored_as_an_address(spark):
    from dimforge.llm.op8_pii import _features, redact

    rows = spark.createDataFrame([(1, "host 10.0.0.1 or 192.168.0.1.")], "doc_id long, text string")
    assert redact(rows).first().text == "host [IP] or [IP]."
    octets = rows.select(*[_features(F.lit(1), F.lit(m), F.lit(""), F.lit(""))["octets"] for m in ("10 . 0 . 00 . 1", "10.0.0.256")]).first()
    assert tuple(octets) == (1.0, 0.0)
