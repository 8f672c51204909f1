"""Stages of the pipeline on empty tables and on columns with any names."""

import pytest

import corpus_pipeline
from grainline.llm import probminhash, quality, substring

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
ODD = "`a.b` int, `my col` string, `n-chars` int, `x:y` int, `d` int, `h` int, `_row` int, `others` int, `listed` int, `kept` int"

GOOD = " ".join(f"word{i}" for i in range(80))


@pytest.fixture
def odd(spark):
    more = (1, "z", 2, 3, 4, 5, 6, 7, 8, 9)
    data = [
        (1, GOOD, "en", "s", 1, *more),
        (2, f"{GOOD} and some more of other words here", "en", None, None, *more),
        (None, None, None, None, None, *more),
        (4, "", "en", "s", 0, *more),
    ]
    return spark.createDataFrame(data, f"{DOCS}, {ODD}")


STAGES = {
    "quality": lambda docs, trusted: quality.kept_documents(docs, trusted, threshold=-1.0),
    "near": lambda docs, trusted: probminhash.deduplicated_documents(docs),
    "substring": lambda docs, trusted: substring.deduplicated_documents(docs),
}


@pytest.mark.parametrize("stage", sorted(STAGES))
def test_columns_may_have_any_names(spark, odd, stage):
    trusted = quality.trusted_documents(spark.createDataFrame([(1, 1, 0)], LABELS))
    for docs, some in ((odd, True), (odd.limit(0), False)):
        out = STAGES[stage](docs, trusted)
        assert out.columns == docs.columns
        found = out.collect()
        assert bool(found) == some
        assert all((r["a.b"], r["my col"], r["n-chars"], r["x:y"]) == (1, "z", 2, 3) for r in found)


def test_the_pipeline_runs_on_odd_and_on_empty_tables(spark, folder, odd, tmp_path):
    given = {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels")}
    wide = given["documents"].selectExpr("*", "1 AS `a.b`", "'z' AS `my col`", "2 AS `x:y`", "3 AS d", "4 AS _row")
    more = odd.select(*given["documents"].columns, "`a.b`", "my col", "x:y", "d", "_row")
    tables = {"odd": (wide.union(more), given["labels"]), "empty": (odd.limit(0), given["labels"].limit(0))}
    counts = {}
    for name, (docs, marks) in tables.items():
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        marks.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        found = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(found.columns)
        counts[name] = found.count()
    assert counts["odd"] > 50 and counts["empty"] == 0
