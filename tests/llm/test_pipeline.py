"""The pipeline's stages, each against brute force on its predecessor's rows."""
import corpus_pipeline
from cartograph.llm import decontaminate, ngram_join, secrets
from cartograph.scratch import left_over

from .conftest import SF, edge_texts
from .test_scans import brute_hits
from .test_similar import brute_classes
from .test_tokens import check_places, expected_pieces, order


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, columns = [tuple(r) for r in docs.collect()], docs.columns
    after = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        assert docs.columns == columns or i == len(corpus_pipeline.STAGES) - 1
        after.append(docs.collect())
    calm, single, clean, safe, packed = after
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {r[0] for r in before} - {r.doc_id for r in calm}
    assert sum(label.get(i) == 1 for i in gone) > 3 * sum(label.get(i) == 0 for i in gone)

    group = {i: c for i, c, _ in brute_classes([(r.doc_id, r.text) for r in calm])}
    assert sorted(r.doc_id for r in single) == sorted(set(group.values()))

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert {r.doc_id for r in clean} == {r.doc_id for r in single if not brute_hits(r.text, items)[1]}

    texts, rules = {r.doc_id: r.text for r in clean}, secrets.compile_rules()
    assert {r.doc_id for r in safe} == set(texts)
    for r in safe:
        found = secrets.find_spans(texts[r.doc_id], rules)
        assert (r.text != texts[r.doc_id]) == bool(found) and r.text.count("[SECRET:") <= len(found)
        assert not secrets.find_spans(r.text, rules)
    pieces = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)
    assert pieces == sorted(expected_pieces([(r.doc_id, r.text) for r in safe]))
    check_places(packed)


def test_run_is_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(rows.columns) and rows.count() > 0
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def folder(spark, tmp_path, name, docs):
    """A data folder with these documents and the labels and benchmark of the test tables."""
    at = f"{tmp_path}/{name}"
    docs.write.parquet(f"{at}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{at}/{t}.parquet")
    return at


def test_edges_copies_and_repeated_rows(spark, edges, tmp_path):
    """Null, empty and very long texts, null ids, copies, repeated rows and further columns."""
    twice = edges.unionByName(edges)
    rows = corpus_pipeline.run(spark, folder(spark, tmp_path, "edges", twice)).collect()
    texts = dict(edge_texts()) | {9: f"[SECRET:{secrets.KINDS[2]}]"}    # 50,000 hexadecimal digits
    kept = [1, 3, 4, 5, 6, 7, 9, 11, None]     # 2 is empty as 1 is; 8 is 7's copy, 10 is 4's
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=order) == sorted(expected_pieces([(i, texts[i]) for i in kept]), key=order)
    check_places(rows)


def test_empty_tables(spark, nothing, tmp_path):
    at = folder(spark, tmp_path, "nothing", nothing)
    rows = corpus_pipeline.run(spark, at)
    assert rows.count() == 0 and "sequence_id" in rows.columns
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{at}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{t}.parquet")
    some = spark.read.parquet(f"{SF}/documents.parquet")
    some.write.parquet(f"{tmp_path}/none/documents.parquet")
    ids = {r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/none").select("doc_id").collect()}
    assert ids and ids <= {r.doc_id for r in some.collect()}


def test_only_the_last_stage_is_left(spark):
    before = set(left_over(spark))
    corpus_pipeline.run(spark, SF)
    assert [x.split("-")[1] for x in set(left_over(spark)) - before if x.startswith("stage-")] == ["best"]


def test_stages_keep_columns_named_like_their_own(spark, tmp_path):
    names = ["__id", "__Copy", "___copy", "__text", "__n_words", "__hits", "__blob", "__spans", "score"]
    text = "a plain text of more than ten words that holds no secret and no window"
    docs = spark.createDataFrame([(1, text, *"abcdefghi"), (2, text, *"jklmnopqr"), (3, None, *[None] * 9)],
                                 "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    benchmark = spark.createDataFrame([("q", "one two three")], "item_id string, text string")
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == sorted(map(tuple, docs.collect()))
    one = ngram_join.keep_one(docs)
    assert one.columns == docs.columns and {tuple(r) for r in one.collect()} == {tuple(r) for r in docs.where("doc_id <> 2").collect()}
    clean = secrets.redact(docs, f"{tmp_path}/ledger")
    assert clean.columns == docs.columns and sorted(map(tuple, clean.collect())) == sorted(map(tuple, docs.collect()))
