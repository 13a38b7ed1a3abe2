from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from refinery.llm.common import table
from refinery.session import shared_root, temporary
from tests.conftest import TABLES
from tests.llm.cases import empty, messy
from tests.llm.test_dedup import plain_groups
from tests.llm.test_packing_search import check

HOME = Path(corpus_pipeline.__file__).parent


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "exact_dedup", "near_dedup", "packing"]


def test_each_stage_against_a_plain_version(spark):
    docs = table(spark, TABLES, "documents")
    marks = {r["doc_id"]: r for r in table(spark, TABLES, "labels").collect()}
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}

    clean = stages["toxicity"](spark, docs, TABLES)
    assert clean.columns == docs.columns
    gone = ids(docs) - ids(clean)
    assert all(marks[i]["toxic"] for i in gone if i in marks) and gone

    good = stages["quality"](spark, clean, TABLES)
    assert good.columns == docs.columns
    fine = {i for i in ids(clean) if i in marks and marks[i]["quality"]}
    assert len(fine - ids(good)) <= 0.02 * len(fine)

    single = stages["exact_dedup"](spark, good, TABLES)
    first = {}
    for r in sorted(good.collect(), key=lambda r: r["doc_id"]):
        first.setdefault(" ".join(r["text"].split()), r["doc_id"])
    assert single.columns == docs.columns and ids(single) == set(first.values())

    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    apart = stages["near_dedup"](spark, good, TABLES)
    assert ids(apart) == {i for i, (_, _, kept) in plain_groups(rows, 5, 80).items() if kept}

    packed = stages["packing"](spark, apart, TABLES).collect()
    sizes, sources = {}, {r["doc_id"]: r["source"] for r in apart.collect()}
    for r in packed:
        sizes[r["doc_id"]] = sizes.get(r["doc_id"], 0) + r["length"]
    assert set(sizes) == ids(apart)
    check(packed, {i: (n, sources[i], i) for i, n in sizes.items()}, corpus_pipeline.CONTEXT, 2)


def test_run_gives_bins_and_leaves_nothing_else(spark, tmp_path):
    root = Path(shared_root(spark).removeprefix("file:"))
    before = set(root.iterdir()) if root.exists() else set()
    found = corpus_pipeline.run(spark, TABLES)
    assert found.columns == ["doc_id", "piece", "start", "length", "shard", "bin", "place"] and found.count() > 0
    assert [p.name.rpartition("-")[0] for p in set(root.iterdir()) - before] == ["stage-packing"]
    before = set(root.iterdir())
    with temporary(spark):
        assert corpus_pipeline.run(spark, TABLES).count() == found.count()
    assert set(root.iterdir()) == before


def test_awkward_documents_pass_every_stage(spark):
    for docs in (messy(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, TABLES)
            assert out.columns == docs.columns
            assert out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, TABLES).select("doc_id").distinct().count() <= docs.count()


def test_the_rest_stands_without_this_part():
    """Nothing outside imports this part, and the entry point does without it."""
    code = (
        "import sys; sys.modules['refinery.llm'] = None; sys.modules['corpus_pipeline'] = None; "
        "import __spark_entry__ as e; assert not any(k.startswith('op') for k in e.queries()); assert 'build_fact' in e.queries()"
    )
    subprocess.run([sys.executable, "-c", code], cwd=HOME, check=True)
    for file in HOME.glob("refinery/**/*.py"):
        assert "llm" in file.parts or "refinery.llm" not in file.read_text(), file
