"""Queries without SQL, each held against a plain version over the whole table, or against held-out rows."""

import hashlib
import re
import zlib

import pytest

# Where each query without SQL is held against something plain.
PLAIN = {
    "op2_mixing": "test_operators.test_mix_targets_and_bounds, test_mix_rows",
    "op3_decontaminate": "test_operators, test_decontamination_edits",
    "op4_html_text": "test_html_whole_text.test_articles_of_the_table_match_a_plain_parser",
    "op6_language_id": "test_language_of_held_out_rows",
    "op8_pii": "test_personal_data_matches_plain_patterns",
    "op10_quality": "test_quality_of_held_out_rows",
    "op12_packing": "test_clusters_packing_divergence",
    "pipeline": "test_mix_rows.test_pipeline_stages_end_to_end",
}


def test_every_query_has_sql_or_a_plain_version():
    from __spark_entry__ import oracle_sql, queries

    assert set(queries()) - set(oracle_sql()) == set(PLAIN)


@pytest.fixture(scope="module")
def big(sf_dir):
    return sf_dir.replace("sf0.001", "sf0.01")


def crc(i, m):
    return zlib.crc32(str(i).encode()) % m


def test_language_of_held_out_rows(spark, big):
    from dimforge.llm.queries import QUERIES

    docs = {r.doc_id: r for r in spark.read.parquet(f"{big}/documents.parquet").collect()}
    got = QUERIES["op6_language_id"](spark, big).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    langs = {d.lang for d in docs.values()} - {None}
    right = [r.lang_pred == docs[r.doc_id].lang for r in got if r.held_out and docs[r.doc_id].lang]
    assert len(right) > 100 and sum(right) >= 0.97 * len(right)
    for r in got:
        assert r.held_out == (crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1
        letters = any(c.isalpha() for c in docs[r.doc_id].text or "")
        assert r.lang_pred in langs if letters else r.lang_pred == "und"


def test_quality_of_held_out_rows(spark, big):
    from dimforge.llm.queries import QUERIES

    docs = [r.doc_id for r in spark.read.parquet(f"{big}/documents.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{big}/labels.parquet").collect() if r.quality is not None}
    got = QUERIES["op10_quality"](spark, big).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (crc(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    judged = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    good, bad = [p for y, p in judged if y == 1], [p for y, p in judged if y == 0]
    assert len(good) > 20 and sum(good) >= 0.97 * len(good)
    assert sum(bad) <= 0.15 * len(bad)


def _luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def plain_spans(text):
    """Base spans (kind, start, end) by the plain patterns."""
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                          ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 16 <= len(digits) <= 19 and _luhn(digits) or kind == "phone" and 8 <= len(digits) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


def test_personal_data_matches_plain_patterns(spark, big):
    from dimforge.llm.queries import QUERIES

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{big}/documents.parquet").collect()}
    got = QUERIES["op8_pii"](spark, big).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    found = 0
    for r in got:
        want = plain_spans(texts[r.doc_id])
        found += len(want)
        assert [getattr(r, f"n_{k}") for k in ("email", "ip", "card", "phone")] == [sum(w[0] == k for w in want) for k in ("email", "ip", "card", "phone")]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        spans = set(filter(None, r.spans.split(",")))
        assert spans >= set(filter(None, joined.split(",")))
        assert all(0 <= int(a) < int(b) <= len(texts[r.doc_id]) for _, a, b in (x.split(":") for x in spans))
    assert found > 50
