"""The pipeline on the smallest tables, stage by stage against what must hold."""

import pytest

from gridlark.llm import decontamination, secrets, simhash
from tests.oracle import compare, connect

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = docs.columns
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        from gridlark.sources.shared import materialize

        after = materialize(stage(spark, before, small))
        assert after.columns == names
        ids = {r.doc_id for r in before.select("doc_id").collect()}
        kept = {r.doc_id for r in after.select("doc_id").collect()}
        assert kept <= ids and after.count() == len(kept)
        if name == "near_duplicates":
            groups = simhash.near_duplicates(before).select("component_id").distinct().count()
            assert len(kept) == groups
        if name == "decontamination":
            benchmark = spark.read.parquet(f"{small}/benchmark.parquet")
            clean = {r.doc_id for r in decontamination.report(before, benchmark).where("not contaminated").collect()}
            assert clean <= kept
        if name == "secrets":
            assert kept == ids
            assert not any(secrets.base_spans(r.text) for r in after.collect())
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, small)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == kept


@pytest.mark.parametrize("name", ["op1_decontamination", "op4_topk"])
def test_sql(spark, small, name):
    from gridlark.llm.queries import ORACLES, QUERIES

    assert compare(spark, connect(small), name, QUERIES[name], ORACLES[name], small)[0] == ""


def test_long_texts_pack(spark):
    """Runs that are longer than the fast encoder can look back over."""
    from gridlark.llm import packing

    long = [" " * 1_000_000, "\n" * 1_000_000, "\t" * 1_000_000, "a" * 1_000_000, "a " + " \n" * 300_000 + "b", "7" * 1_000_000]
    slow = packing._encoder(packing.tokenizer_files()[0], None, None)
    got = packing.pieces(spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")).collect()
    for i, text in enumerate(long):
        assert sum(r.length for r in got if r.doc_id == i) == len(slow(text)) + 1


def test_keep_one_with_clashing_names(spark):
    rows = [(1, "a b c d", "x", 5, 6, 7), (2, "a b c d", "y", 5, 6, 7), (3, "other words are here now", "z", 5, 6, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, first_id string, first_digest long, digest long, bucket_rows int")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_decontamination_matches_each_text_once(spark, small):
    docs, benchmark = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = decontamination.decontaminate(docs, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_one_automaton_is_held_at_a_time(spark, small, monkeypatch):
    """With many small automata each is gone before the next is broadcast, and the result is that of one."""
    docs, benchmark = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    live, most, plain = [], [], decontamination.fresh

    class Watched:
        def __init__(self, shared):
            self.shared = shared

        value = property(lambda self: self.shared.value)

        def destroy(self):
            live.remove(self)
            self.shared.destroy()

        def __reduce__(self):
            return self.shared.__reduce__()

    def fresh(session, value):
        live.append(Watched(plain(session, value)))
        most.append(len(live))
        return live[-1]

    one = sorted(map(str, decontamination.report(docs, benchmark).collect()))
    monkeypatch.setattr(decontamination, "fresh", fresh)
    many = decontamination.matched(docs, benchmark, limit=400)
    assert len(most) > 3 and max(most) == 1
    hit = {r.doc_id for r in many.where("size(starts) > 0").select("doc_id").collect()}
    monkeypatch.undo()
    whole = {r.doc_id for r in decontamination.matched(docs, benchmark).where("size(starts) > 0").select("doc_id").collect()}
    assert hit == whole and one
