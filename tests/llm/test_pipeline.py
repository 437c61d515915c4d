import importlib
import os
import sys

import pytest

from conftest_llm import plain_words

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def pipeline():
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sys.path.insert(0, top)
    return importlib.import_module("corpus_pipeline")


def test_each_stage_does_to_its_input_what_its_operator_says(spark, pipeline):
    """Every stage against plain Python on what the stage before kept."""
    import sentencepiece
    from test_decontaminate import brute as hits
    from test_repeats import brute as cuts
    from test_simhash import components_of, fingerprint

    from millrace.llm import queries, repeats
    from millrace.scratch import materialize

    rows = queries.table(spark, FOLDER, "documents")
    columns, kept = rows.schema, {}
    for name, stage in pipeline.STAGES:
        rows = materialize(stage(spark, rows, FOLDER), name)
        kept[name] = rows
        if name != "encoding":
            assert [(c.name, c.dataType) for c in rows.schema] == [(c.name, c.dataType) for c in columns]

    def texts(name):
        return sorted((r.doc_id, r.text) for r in kept[name].collect())

    good = {r.doc_id for r in queries.quality_scores(spark, FOLDER).where("predicted = 1").collect()}
    assert {i for i, _ in texts("quality")} == good

    before = texts("quality")
    roots = components_of([fingerprint(t) for _, t in before], 4)
    first = {}
    for (i, t), r in zip(before, roots):
        first.setdefault(r, (i, t))
    assert texts("near_duplicates") == sorted(first.values())

    before = texts("near_duplicates")
    runs = {int(i): cut for i, _, cut, _ in cuts(before, pipeline.PASSAGE.length, pipeline.PASSAGE.words)}
    assert texts("repeats") == [(i, repeats.kept_text(t.encode(), runs[i])) for i, t in before]
    assert all(r.n_chars == len(r.text) for r in kept["repeats"].collect() if runs[r.doc_id])

    before = texts("repeats")
    items = [(r.item_id, r.text) for r in queries.table(spark, FOLDER, "benchmark").collect()]
    bad = {i for i, n, hit, _ in hits(before, items) if hit and 20 * hit >= n}
    assert texts("benchmark") == [(i, t) for i, t in before if i not in bad]

    theirs = sentencepiece.SentencePieceProcessor(model_proto=queries.model_bytes())
    ids = sorted((r.doc_id, list(r.ids)) for r in kept["encoding"].collect())
    assert ids == [(i, theirs.encode(t)) for i, t in texts("benchmark")]
    assert len(good) > len(first) > len(ids) > 0 and plain_words("Ä A") == "Ä a"


def test_run_applies_all_stages(spark, pipeline):
    assert [name for name, _ in pipeline.STAGES] == ["quality", "near_duplicates", "repeats", "benchmark", "encoding"]
    rows = pipeline.run(spark, FOLDER)
    assert rows.count() > 0 and "ids" in rows.columns


CLASHES = "id bits k1 k2 row runs items new score text_key component_id node at"


def odd_documents(spark, queries):
    """Good documents and odd rows, with columns whose names clash."""
    from pyspark.sql import functions as F

    rows = queries.table(spark, FOLDER, "documents")
    texts = [r.text for r in rows.orderBy("doc_id").limit(6).collect()]
    long = " ".join(f"{w}{k * k % 1_000_003}" for k, w in enumerate("the of and to in is that it for on with as".split() * 25_000))
    odd = [(900, None), (901, ""), (902, " \n\t"), (903, None), (None, texts[1] + " tail"), (None, texts[1] + " tail"), (904, long), (905, "é" * 3000), (906, "a " * 5000)]
    odd += [(0, texts[0])] * 3 + [(907 + k, texts[2]) for k in range(3)]
    more = spark.createDataFrame([(i, t, "en", "odd", None if t is None else len(t)) for i, t in odd], rows.schema)
    return rows.unionByName(more).withColumns({c: F.lit(f"own {c}") for c in CLASHES.split()})


def test_odd_rows_and_columns_at_every_stage(spark, pipeline):
    from millrace.llm import queries
    from millrace.scratch import materialize

    docs = materialize(odd_documents(spark, queries), "odd")
    before = docs
    for name, stage in pipeline.STAGES[:-1]:
        after = materialize(stage(spark, before, FOLDER), name)
        assert [(c.name, c.dataType) for c in after.schema] == [(c.name, c.dataType) for c in docs.schema]
        assert all(r[c] == f"own {c}" for r in after.select(*CLASHES.split()).distinct().collect() for c in CLASHES.split())
        here, there = ([(r.doc_id, r.source) for r in x.collect()] for x in (after, before))
        assert len(here) <= len(there) and set(here) <= set(there)
        if name == "near_duplicates":
            ids = [r.doc_id for r in after.collect()]
            assert ids.count(0) <= 1 and sum(i in (900, 901, 902, 903) for i in ids) <= 1 and ids.count(None) <= 1
            assert sum(i in (2, 907, 908, 909) for i in ids) <= 1
        if name in ("repeats", "near_duplicates"):
            blank = {r.doc_id: r.text for r in after.where("doc_id in (900, 901, 902, 903)").collect()}
            assert all(text == {900: None, 901: "", 902: " \n\t", 903: None}[i] for i, text in blank.items())
        before = after
    name, stage = pipeline.STAGES[-1]
    ids = {r.doc_id: r["ids"] for r in stage(spark, before, FOLDER).collect()}
    assert len(ids) == before.count() and all(not ids[i] for i in (900, 901, 903) if i in ids)


def test_every_stage_takes_each_odd_row_by_itself(spark, pipeline):
    """Without the stages before: nothing crashes, and no clean document goes at a stage that has no reason to drop it."""
    from millrace.llm import queries
    from millrace.scratch import materialize

    docs = materialize(odd_documents(spark, queries).where("source = 'odd'"), "odd")
    stages = dict(pipeline.STAGES)
    single = [(r.doc_id, r.text) for r in stages["near_duplicates"](spark, docs, FOLDER).collect()]
    assert sorted(str(i) for i, _ in single) == sorted(map(str, [None, 0, 900, 904, 905, 906, 907]))
    cut = {(r.doc_id, r.text is None): r.text for r in stages["repeats"](spark, docs, FOLDER).collect()}
    assert cut[900, True] is None and cut[901, False] == "" and cut[905, False] == "" and cut[907, False] == cut[908, False] == ""
    assert len(cut[904, False]) > 1_000_000
    assert stages["benchmark"](spark, docs, FOLDER).count() == docs.count()
    assert {r.doc_id for r in stages["encoding"](spark, docs, FOLDER).collect()} == {r.doc_id for r in docs.collect()}


def test_an_empty_table_passes_every_stage(spark, pipeline):
    from millrace.llm import queries
    from millrace.scratch import materialize

    rows = materialize(queries.table(spark, FOLDER, "documents").limit(0), "none")
    for name, stage in pipeline.STAGES:
        rows = materialize(stage(spark, rows, FOLDER), name)
        assert rows.count() == 0
