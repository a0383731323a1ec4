"""Each stage of the pipeline against brute force, on what the stage before has kept."""

from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
from forgepulse.llm.common import stored
from tests.llm.fixtures import SCHEMA, prose, unique_rows
from tests.llm.test_operators import check_places, components, item_words, near_copies, removed_whole_runs


def test_stages(spark, tmp_path):
    leak = prose(9, 80)
    rows = unique_rows() + near_copies()[:60] + [
        (300, prose(3, 80) + " " + leak, "en", "s", 1), (301, "too short", "en", "s", 1), (302, "again " * 80, "en", "s", 1),
    ]
    sf = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, leak[:200]), (2, None)], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    labels = [(r[0], 1, 0) for r in rows if r[0] < 300]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")

    docs, kept = spark.read.parquet(f"{sf}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        result = stored(stage(spark, docs, sf), "stage")
        kept.append([(r.doc_id, r.text) for r in result.collect()] if stage is not corpus_pipeline.STAGES[-1][1] else result.collect())
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert result.dtypes == docs.dtypes
        docs = result
    good, lines, near, clean, pieces = kept

    ids = {i for i, _ in good}
    assert not ids & {5, 6, 7, 8, 301, 302} and {1, 300} <= ids

    gone, want = removed_whole_runs(good, corpus_pipeline.line_dedup.MIN_WORDS), Counter()
    for k, (i, text) in enumerate(good):
        left = [x for n, x in enumerate(text.split("\n")) if n not in gone[k]]
        if left:
            want[i, "\n".join(left)] += 1
    assert Counter(lines) == want

    groups = defaultdict(list)
    for (i, _), root in zip(lines, components(lines)[1], strict=True):
        groups[root].append(i)
    assert {i for i, _ in near} == {min(g) for g in groups.values()} and len(near) == len(groups)

    item = item_words(leak[:200])
    spans = {tuple(item[k : k + 10]) for k in range(len(item) - 9)}
    hit = lambda t: any(tuple(item_words(t)[k : k + 10]) in spans for k in range(len(item_words(t))))
    assert Counter(clean) == Counter(x for x in near if not hit(x[1])) and 300 not in {i for i, _ in clean}

    assert {r.doc_id for r in pieces} == {i for i, _ in clean}
    check_places(pieces)
    assert len(corpus_pipeline.run(spark, sf).collect()) == len(pieces)


def test_stages_without_documents(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
