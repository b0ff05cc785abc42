"""Rows with a NULL doc_id in the stages that join."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(spark, pairs):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in pairs], SCHEMA)


def kept(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in df.collect())


def texts(n):
    return " ".join(f"t{n}w{k}" for k in range(40))


def test_one_row_per_component_with_null_ids(spark):
    from dimforge.llm.op7_jaccard_join import jaccard_components, keep_one_per_component

    near = texts(1) + " more"
    docs = rows_of(spark, [
        (None, texts(0)),                                  # unique, without an id
        (5, texts(1)), (None, near), (3, texts(1).upper()),  # one component, smallest id 3
        (None, texts(2)), (None, texts(2)), (None, texts(2) + " more"),  # a component without ids
        (7, texts(3)), (7, texts(3)), (7, texts(4)),       # one id, two components
        (None, None), (None, ""), (None, ""), (8, " "), (8, " "), (8, "\n"), (9, None), (9, "")])
    got = kept(keep_one_per_component(docs))
    lone = [x for x in got if x[0] and x[2].startswith("t2")]
    assert len(lone) == 1
    got.remove(lone[0])
    assert got == sorted([(True, 0, texts(0)), (False, 3, texts(1).upper()), (False, 7, texts(3)), (False, 7, texts(4)),
                          (True, 0, ""), (True, 0, ""), (True, 0, ""), (False, 8, " "), (False, 8, "\n"), (False, 9, ""), (False, 9, "")])
    ids = [(r.doc_id, r.component_id) for r in jaccard_components(docs.select("doc_id", "text")).filter("n_shingles > 0").collect()]
    assert sorted(ids, key=str) == sorted([(None, None)] * 4 + [(5, 3), (None, 3), (3, 3)] + [(7, 7)] * 3, key=str)
    assert keep_one_per_component(docs.filter("false")).count() == 0


def test_decontamination_stage_drops_leaking_rows_without_an_id(spark, tmp_path):
    import corpus_pipeline

    items = spark.createDataFrame([(None, texts(6)), (1, texts(7))], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = rows_of(spark, [(None, texts(0)), (None, "see " + texts(6)), (2, texts(7)), (2, texts(8)), (None, None), (4, texts(9))])
    got = kept(corpus_pipeline.decontamination_stage(spark, docs, str(tmp_path)))
    assert got == sorted([(True, 0, texts(0)), (False, 2, texts(8)), (True, 0, ""), (False, 4, texts(9))])
