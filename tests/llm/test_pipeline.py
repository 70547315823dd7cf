from collections import Counter

import corpus_pipeline
from segwatch.llm import simhash_tree
from test_pii import plain as plain_pii
from test_quality_lines import plain as plain_quality
from test_simhash_tree import plain_components, plain_print
from test_suffix_dedup import plain_words


def test_stages_one_by_one(spark, data, tmp_path):
    sf_dir = data("0.001", "documents").rsplit("/", 1)[0]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(out)
        before, docs = docs, spark.read.parquet(out)
        if i < 4:
            assert docs.columns == columns
            assert docs.where("n_chars <> length(text)").count() == 0
        kept[name] = before, docs
    rows = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]

    before, after = map(rows, kept["quality"])
    bad = {i for i, t in before if plain_quality(t)[-1]}
    assert not bad & {i for i, _ in after} and len(after) > 0.5 * (len(before) - len(bad))
    before, after = map(rows, kept["near_dedup"])
    groups = plain_components([(i, plain_print(t)) for i, t in before])
    assert Counter(after) == Counter((i, t) for i, t in dict(before).items() if i in {c for _, _, c in groups})
    before, after = kept["passage_dedup"]
    wanted = plain_words(rows(before), 51, True)
    assert Counter(rows(after)) == Counter({(i, t): n for (i, _, t), n in wanted.items()})
    _, after = kept["personal"]
    assert not any(plain_pii(t) for _, t in rows(after))
    before, after = kept["packing"]
    assert {r["doc_id"] for r in after.collect()} == {i for i, _ in rows(before)}
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf_dir).select("doc_id", "start", "length", "ids_crc32").collect())) == Counter(
        map(tuple, after.select("doc_id", "start", "length", "ids_crc32").collect()))


def test_awkward_rows_pass_through_every_stage(spark, tmp_path):
    from conftest_llm import EDGES

    docs = spark.createDataFrame([(i, t, None, "s", None, 5) for i, t in EDGES], "doc_id bigint, text string, lang string, source string, n_chars bigint, mark int")
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, rows, "").collect()
    one = corpus_pipeline.near_dedup(spark, docs, "").collect()
    groups = {r["root"] for r in simhash_tree.near_duplicates(docs).collect()}
    assert len(one) == len(groups)


def test_a_short_passage_of_51_words_stays_once(spark):
    passage = " ".join(f"word{i % 9}" for i in range(40)) + " and " + " ".join(f"b{i}" for i in range(10))
    assert len(passage.split()) == 51 and len(passage) < 300
    rows = [(i, f"Document begins{i} {passage} ends{i} here.", "en", "s", 0) for i in (7, 3, 9)] + [(4, passage[:-3] + "end", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.passage_dedup(spark, docs, "").collect()}
    assert passage in left[3] and left[4] == rows[3][1]
    assert left[7] == "Document begins7  ends7 here." and left[9] == "Document begins9  ends9 here."
