"""The pipeline stage by stage against plain code, on the smallest tables."""

import os
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(os.path.dirname(HERE)), HERE]

import corpus_pipeline as cp
from evergreen.llm import bpe, quality, toxicity
from evergreen.llm.common import read
from test_fingerprints import plain_components, plain_fingerprint
from test_texts import leaks_by_hand

D = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read(spark, D, "documents")
    labels = read(spark, D, "labels")
    lexicon = toxicity.fit(toxicity.training_rows(docs, labels))
    model = quality.fit(quality.training_rows(docs, labels))
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    toxic = toxicity.scorer(lexicon)
    rows = {i: t for i, t in rows.items() if toxic(t)[0] < toxicity.CUT}
    good = quality._tails
    rows = {i: t for i, t in rows.items() if good(model, quality.features(t)[None, :])[0, 0] >= quality.CUT}
    ids = sorted(rows)
    fps = {i: plain_fingerprint(rows[i]) for i in ids}
    root = plain_components(ids, lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 4)
    rows = {i: t for i, t in rows.items() if root[i] == i}
    items = [(r["item_id"], r["text"]) for r in read(spark, D, "benchmark").collect()]
    leaky = {x[0] for x in leaks_by_hand(list(rows.items()), items)}
    rows = {i: t for i, t in rows.items() if i not in leaky}
    own = bpe.tokenizer(bpe.vocabulary_path())
    got = {r["doc_id"]: r["n_tokens"] for r in cp.run(spark, D).collect()}
    assert got == {i: len(own.encode(t)) for i, t in rows.items()} and 50 < len(got) < docs.count()


def test_stages_keep_the_columns(spark):
    docs = read(spark, D, "documents").limit(40)
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, docs, D).columns == docs.columns


def test_no_documents(spark):
    docs = read(spark, D, "documents").filter("false")
    for _, stage in cp.STAGES:
        assert stage(spark, docs, D).count() == 0
