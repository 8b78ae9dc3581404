"""Each stage of the corpus pipeline against what its operator says of the same input."""

import corpus_pipeline as C
from gridpanel.llm import decontaminate, jaccard, language, toxicity
from gridpanel.llm.common import written
from gridpanel.session import table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n for n, _ in C.STAGES] == ["language_id", "toxicity", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]
    docs = table(spark, SF, "documents")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    for name, stage in C.STAGES:
        out = written(spark, stage(spark, docs, SF), name)
        if name == "language_id":
            want = language.identify(docs, language.fit(docs)).where("lang_pred <> 'und' and score >= 0.3")
        elif name == "toxicity":
            want = toxicity.score(docs, toxicity.fit(docs, table(spark, SF, "labels"))).where("score < 0.5")
        elif name == "ngram_jaccard_join":
            want = jaccard.join(docs).where("doc_id = component_id")
        elif name == "benchmark_decontamination":
            want = decontaminate.digest_columns(decontaminate.overlap(docs, table(spark, SF, "benchmark"))).where("not contaminated")
        else:
            assert set(ids(out)) == set(ids(docs))
            break
        assert out.columns == docs.columns and ids(out) == ids(want) and 0 < out.count() <= docs.count()
        docs = out


def test_odd_rows_go_through_every_stage(spark):
    base = table(spark, SF, "documents")
    text = base.where("lang = 'en' and length(text) > 400").orderBy("doc_id").first().text
    rows = [(-1, None), (-2, ""), (-3, " \t"), (-4, "123 456"), (-5, text), (-5, text), (-6, text), (None, text + " end"),
            (-7, " ".join(f"{w} and the house" for w in text.split()) * 40)]
    odd = spark.createDataFrame([(i, t, "en", "s", 1, "x", 2, "y") for i, t in rows],
                                "doc_id bigint, text string, lang string, source string, n_chars bigint, cls string, id int, score string")
    docs = odd.unionByName(base.limit(60), allowMissingColumns=True)
    ids = lambda df: [r.doc_id for r in df.select("doc_id").collect()]
    for name, stage in C.STAGES[:-1]:
        out = written(spark, stage(spark, docs, SF), name)
        assert out.schema.simpleString() == docs.schema.simpleString()
        kept = ids(out)
        if name == "language_id":
            assert not {-1, -2, -3, -4} & set(kept) and kept.count(-5) == 2
        if name == "ngram_jaccard_join" and {-5, -6} & set(ids(docs)):
            assert len([i for i in kept if i in (-5, -6)]) <= 1 and sorted(set(kept), key=str) == sorted(kept, key=str)
        docs = out
    packed = C.STAGES[-1][1](spark, docs, SF)
    assert set(ids(packed)) == set(ids(docs))


def test_empty_table_goes_through_every_stage(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
