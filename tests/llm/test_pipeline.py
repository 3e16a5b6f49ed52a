"""The pipeline and the registered queries."""

import random

import public_tokenizers
import sentencepiece

import corpus_pipeline
from oracle import duck, rows_of, rows_of_sql
from test_near_dedup import brute
from tailmap.llm import exact_dedup, langid, minhash, mixing
from tailmap.llm.common import table
from tailmap.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_queries_with_sql(spark):
    db = duck(SF)
    for name, sql in ORACLES.items():
        assert rows_of(QUERIES[name](spark, SF)) == rows_of_sql(db, sql), name


def test_queries_cover_their_tables(spark):
    n = table(spark, SF, "documents").count()
    for name in set(QUERIES) - set(ORACLES):
        assert QUERIES[name](spark, SF).count() == n, name


def test_stages(spark):
    docs, ids = table(spark, SF, "documents"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF).cache()
        assert kept.columns == columns, name
        assert kept.select("doc_id").exceptAll(docs.select("doc_id").union(docs.select("doc_id"))).count() == 0
        ids.append(kept.count())
        docs = kept
    got = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((r.doc_id, sp.encode(r.text)) for r in docs.collect())
    assert sorted((r.doc_id, list(r.ids)) for r in got) == want
    assert len(got) == corpus_pipeline.run(spark, SF).count() == ids[-1]


def test_stages_take_nulls_and_nothing(spark):
    schema = table(spark, SF, "documents").schema
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", None, 3), (2, "word " * 9, None, "s", None), (2, "word " * 9, None, "s", None), (3, "", "en", "s", 0)], schema)
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SF).count() <= 2 * docs.count(), name
    assert exact_dedup.dedup_exact(odd).count() == 2
    assert minhash.dedup_near(odd).count() == odd.count()
    assert langid.keep_identified(odd).count() == 2
    assert mixing.take_mix(odd).select("doc_id").distinct().count() == 1


def test_exact_dedup_drops_by_id_and_text(spark):
    rows = [(None, "a"), (1, "A"), (None, "b"), (5, "x"), (5, "y"), (6, "x"), (7, None), (None, ""), (None, "c"), (None, "c")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, _own_text int")
    got = exact_dedup.dedup_exact(docs)
    assert got.columns == docs.columns
    kept = [r["_own_text"] for r in got.collect()]
    # Of two equal rows any one stays.
    assert sorted(min(i, 8) for i in kept) == [1, 2, 4, 5, 6, 8]


def test_exact_dedup_keeps_one_row_a_text(spark):
    pick = random.Random(11)
    rows = [(pick.choice([None, 1, 2, 3, 4]), pick.choice(["", None, "a", "A", "b", "unique", "z", "aab" * 900]), i) for i in range(60)] + [(9, "only", 60)]
    for some in (rows, [(1, "a", 0), (2, "a", 1), (1, "unique", 2), (5, "z", 3), (5, "z", 4)], [(1, "a", 0), (1, "b", 1)]):
        best = {}
        for i, t, _ in some:
            low = ascii_low(t)
            best[low] = max((x for x in (best.get(low), i) if x is not None), default=None)
        got = exact_dedup.dedup_exact(spark.createDataFrame(some, "doc_id long, text string, extra int").repartition(3)).collect()
        assert sorted((str(r.doc_id), ascii_low(r.text)) for r in got) == sorted((str(i), t) for t, i in best.items())
        assert all((r.doc_id, r.text) == some[r.extra][:2] for r in got)


def test_unlearned_scripts_go(spark):
    docs, pick = table(spark, SF, "documents").select("doc_id", "text", "lang"), random.Random(7)
    word = lambda first, last: "".join(chr(pick.randint(first, last)) for _ in range(pick.randint(2, 9)))
    odd = [(10_000 + i, " ".join(word(*((0x3B1, 0x3C9), (0x430, 0x44F), (0x4E00, 0x9FFF))[i % 3]) for _ in range(i % 60 + 5)), None) for i in range(300)]
    kept = langid.keep_identified(docs.union(spark.createDataFrame(odd, docs.schema)))
    assert kept.where("doc_id >= 10000").count() <= 3
    assert kept.where("doc_id < 10000").count() == docs.count()


def test_run_stores_between_stages(spark, monkeypatch):
    read = []

    def look(spark, docs, sf_dir):
        read.append(docs.inputFiles())
        return docs.where("doc_id % 2 = 0")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("a", look), ("b", look), ("c", look)])
    assert corpus_pipeline.run(spark, SF).count() == 100
    assert "documents.parquet" in read[0][0] and "/stage-1-" in read[1][0] and "/stage-2-" in read[2][0]


def test_dedup_stages_by_brute_force(spark):
    docs = table(spark, SF, "documents")
    best = {}
    for r in docs.collect():
        low = ascii_low(r.text)
        best[low] = max(r.doc_id, best.get(low, -1))
    kept = corpus_pipeline.drop_copies(spark, docs, SF)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(best.values())
    want = brute([(r.doc_id, r.text) for r in kept.collect()], percent=80)
    assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, kept, SF).collect()} == {i for i, (_, _, stays) in want.items() if stays}


def ascii_low(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")
