"""The mixing stage takes, row by row, what the mix decides; also without ids, with repeated ids and clashing columns."""

from collections import Counter

import pytest


@pytest.fixture
def docs(spark, tmp_path):
    def written(rows, extra=""):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long" + extra)
        path = f"{tmp_path}/docs{len(rows)}{len(extra)}"
        df.repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return written


def words(n):
    return " ".join(["w"] * n)


@pytest.mark.parametrize("ids", [lambda i: None, lambda i: i % 50, lambda i: i])
def test_words_taken_equal_the_mix(spark, docs, ids):
    from dimforge.llm.op2_mixing import mix, mix_documents

    rows = [(ids(i), words(1 + i % 90), "en", "ab"[i % 2], i) for i in range(400)]
    df = docs(rows)
    want = Counter((r.doc_id, r.source, r.size, r.copies) for r in mix(df).collect() if r.copies)
    got = mix_documents(df).collect()
    assert Counter((r.doc_id, r.source, r.size, r.copies) for r in got) == want
    assert all(len(r.text.split()) == r.size and r.taken == r.size * r.copies for r in got)
    for source in "ab":
        target = next(r.target for r in got if r.source == source)
        assert abs(sum(r.taken for r in got if r.source == source) - target) <= 0.02 * target + 90


def test_clashing_columns_and_no_rows(spark, docs):
    from dimforge.llm.op2_mixing import mix_documents

    df = docs([(i, words(5), "en", "a", 1, 7, 8, "r", "k") for i in range(20)], ", size int, copies int, row string, mix_row string")
    got = mix_documents(df)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "mix_row", "size", "source_size", "target", "copies", "taken"]
    assert all(r.mix_row == "k" and r.size == 5 for r in got.collect())
    assert mix_documents(df.filter("false")).collect() == []
    assert mix_documents(spark.createDataFrame([], df.schema)).collect() == []


def test_a_hot_id_is_dealt_over_blocks(spark, docs, monkeypatch):
    from dimforge.llm import op2_mixing as op

    monkeypatch.setattr(op, "BLOCK", 32)
    sizes = []
    real = op.materialise

    def noted(df, name):
        out = real(df, name)
        if name == "mix-level":
            sizes.extend(r[0] for r in out.selectExpr("size(r.done) + 1").collect())
        return out

    monkeypatch.setattr(op, "materialise", noted)
    op.mix(docs([(None, words(3), "en", "a", 1)] * 2000)).collect()
    assert max(sizes) <= 32 * 4


def test_pipeline_stages_end_to_end(spark, sf_dir):
    """Each stage against a plain statement of what it must do to the rows its predecessor kept."""
    import corpus_pipeline as p
    from dimforge.llm.common import materialise, table

    docs, kept = table(spark, sf_dir, "documents"), {}
    for name, stage in p.STAGES:
        before = docs
        docs = materialise(stage(spark, docs, sf_dir), f"test-{name}")
        kept[name] = Counter((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
        if name == "quality":
            from dimforge.llm.op10_quality import learnable, score

            good = score(before, learnable(table(spark, sf_dir, "labels"))).filter("predicted = 1")
            assert Counter(r[0] for r in good.select("doc_id").collect()) == Counter(k[0] for k in kept[name].elements())
        elif name == "near_duplicates":
            shingles = {}
            for r in before.collect():
                w = (r.text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
                shingles[r.doc_id] = {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
            stay = [k[0] for k in kept[name]]
            linked = lambda a, b: a and b and 100 * len(a & b) >= 75 * len(a | b)
            assert not any(linked(shingles[a], shingles[b]) for i, a in enumerate(stay) for b in stay[:i])
            gone = set(shingles) - set(stay)
            assert all(any(linked(shingles[g], shingles[o]) for o in shingles if o != g) for g in gone)
        elif name == "decontamination":
            from dimforge.llm.op3_decontaminate import leaks

            found = {r.doc_id for r in leaks(before, table(spark, sf_dir, "benchmark")).collect()}
            assert {k[0] for k in kept[name]} == {r.doc_id for r in before.collect()} - found
        elif name == "privacy":
            texts = {r.doc_id: r.text for r in docs.collect()}
            assert set(texts) == {r.doc_id for r in before.collect()}
            assert not any("@" in t and __import__("re").search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t) for t in texts.values() if t)
        else:
            assert set(kept[name]) <= {(r.doc_id, r.text) for r in before.collect()}
            assert set(p.COLUMNS) < set(docs.columns)
