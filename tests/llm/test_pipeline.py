import corpus_pipeline
from deidflow.llm import bpe, neardup, pii, quality


def test_stages_over_a_small_corpus(spark, tmp_path, docs, prose):
    base = prose(60)
    rows = [(1, base + " 4785380592391139", "s"), (2, base + " tail", "s"), (3, prose(50), "s"), (4, "too short", "s"), (5, prose(50) + " mail me.now@x.example.org", "t"), (6, None, "t")]
    table = docs(rows).select("doc_id", "text", "lang", "source", "n_chars")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stage, names = table, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "neardup", "pii", "mixing", "bpe"]
    seen = []
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, stage, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        stage = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append({r.doc_id for r in stage.collect()})
        assert k == 4 or stage.columns == table.columns
    assert seen == [{1, 2, 3, 5}, {1, 3, 5}, {1, 3, 5}, {1, 3, 5}, {1, 3, 5}]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tmp_path}/2").collect()}
    assert "4785380592391139" not in texts[1] and texts[3] == rows[2][1] and "me.now@" not in texts[5]
    final = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert final == {r.doc_id: (r.n_tokens, r.ids_sha256) for r in stage.collect()}
    by_hand = bpe.encode(pii.pseudonymise(neardup.keep(quality.keep(table)), pii.DEMO_KEY).drop("pii"), ids=False)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256) for r in by_hand.collect()} == final


def test_edges_and_columns_of_any_name(spark, tmp_path, prose):
    long, twice, other = prose(30_000), prose(60), prose(50)
    rows = [(1, long), (2, twice), (2, twice), (3, None), (4, ""), (None, other), (6, prose(40) + " 8.8.8.8"), (7, twice)]
    names = ["rate", "copies", "domain", "posterior", "n_tokens", "pii", "_hits", "_c0", "key", "n_words", "kept", "host", "component_id", "rep", "class", "size", "word", "node"]
    full = [(i, t, "en", "s", len(t or ""), *(f"own {n}" for n in names)) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    table = spark.createDataFrame(full, schema)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 0, 1), (9, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stage = table
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, stage, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        stage = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert stage.columns == table.columns and all(r[n] == f"own {n}" for r in stage.collect() for n in names)
        if k == 1:
            assert sorted((r.doc_id for r in stage.collect()), key=str) == [1, 2, 6, None]
    assert {r.doc_id for r in stage.collect()} <= {1, 2, 6, None}
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{tmp_path}/e/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/e/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/e").count() == 0
