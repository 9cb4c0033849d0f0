"""The registered queries on given tables, and the pipeline's stages against brute force."""

import os

import duckdb
import pytest

from docmonitor.llm.registry import ORACLE, QUERIES
from samples import prose
from test_joins import components_by_hand, lines_by_hand, near_rows

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "embeddings", "labels", "conversations")


@pytest.fixture(scope="module")
def data():
    if not os.path.isdir(SF_DIR):
        pytest.skip("test data not available")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_each_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(shared, data, name):
    got, want = QUERIES[name](shared, SF_DIR).toPandas(), data.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want) > 0
    rows = lambda df: sorted(map(repr, df[sorted(df.columns)].astype(object).where(df.notna(), None).values.tolist()))
    assert rows(got) == rows(want) or [r.replace(".0", "") for r in rows(got)] == [r.replace(".0", "") for r in rows(want)]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_covers_its_table(shared, data, name):
    out = QUERIES[name](shared, SF_DIR).toPandas()
    if name.startswith("op9"):
        ids = data.execute("SELECT vec_id FROM embeddings WHERE vec_id % 100 = 0").df()["vec_id"]
        assert set(out["query_id"]) == set(ids) and len(out) == 10 * len(ids)
    else:
        assert set(out["doc_id"]) == set(data.execute("SELECT doc_id FROM documents").df()["doc_id"])


def test_pipeline_stages(shared, documents, mixed_rows, tmp_path):
    import corpus_pipeline as pipeline

    shared_line = prose(999, 12)
    rows = [(i, f"{t}\n{shared_line}" if i and i % 4 == 0 and t else t, lang, s) for i, t, lang, s in near_rows() + mixed_rows]
    first = documents(rows).drop("kept", "size", "copies")
    columns = first.columns
    docs, stages = first, dict(pipeline.STAGES)
    key = lambda x: tuple((v is None, v or 0) for v in x)

    def step(name, docs):
        path = str(tmp_path / name)
        stages[name](shared, docs, SF_DIR).write.parquet(path)
        out = shared.read.parquet(path)
        return out, [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in out.collect()] if "text" in out.columns else out.collect()

    docs, kept = step("quality_rules", docs)
    assert docs.columns == columns and 0 < len(kept) < len(rows) and not set(kept) - set(rows)

    docs, cleaned = step("line_dedup", docs)
    want = [(i, t) for i, t, removed in lines_by_hand(kept, 4, 4) if not removed or t.split()]
    assert sorted(((i, t) for i, t, *_ in cleaned), key=key) == sorted(want, key=key)
    assert sum(shared_line in t for _, t in want) < sum(shared_line in t for _, t, *_ in kept)
    assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())

    docs, single = step("near_duplicates", docs)
    groups = {c for _, _, c in components_by_hand(cleaned, 5, 80)}
    assert len(single) == len(groups) and {i for i, *_ in single if i is not None} == groups - {None}

    docs, mixed = step("mix_sources", docs)
    words = lambda x: sum(len(t.split()) for _, t, *_ in x)
    assert not set(mixed) - set(single) and max(mixed.count(x) for x in set(mixed)) <= 2
    longest = max(len(t.split()) for _, t, *_ in single)
    assert abs(words(mixed) - 1.5 * words(single)) <= longest * len({s for *_, s in single})

    _, packed = step("best_fit_packing", docs)
    assert sorted((r["doc_id"] or -1 for r in packed if r["piece"] == 0)) == sorted(i or -1 for i, *_ in mixed)
    sizes = {}
    for r in packed:
        sizes[r["sequence_id"]] = sizes.get(r["sequence_id"], 0) + r["length"]
    assert max(sizes.values()) <= 2048


def test_pipeline_of_nothing(shared, documents):
    import corpus_pipeline as pipeline

    docs = documents([]).drop("kept", "size", "copies")
    for _, stage in pipeline.STAGES:
        docs = stage(shared, docs, SF_DIR)
        assert docs.collect() == []


CLASHING = ("kept", "n_lines", "n_removed", "row_key", "_row_key", "_key", "_one", "_removed", "_copies", "_own_lang", "size", "copies",
            "_first", "_place", "extra0", "extra9", "fp", "site", "text_key", "place", "block", "a.b")


def test_pipeline_stages_carry_all_columns(shared):
    """Columns of any name come through, ``source`` and ``lang`` may be missing, and rows repeated 1,000 times are no trouble."""
    import corpus_pipeline as pipeline
    from pyspark.sql import functions as F

    rows = [(i, prose(i, 30 + i)) for i in range(30)] + [(40, prose(40, 60))] * 1000 + [(None, prose(41, 50)), (42, prose(3, 33)), (43, None)]
    docs = shared.createDataFrame(rows, "doc_id long, text string").repartition(5)
    docs = docs.select("*", *(F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in CLASHING))
    sizes = []
    for name, stage in pipeline.STAGES[:-1]:
        docs = pipeline.materialise(stage(shared, docs, SF_DIR), name)
        assert docs.columns == ["doc_id", "text", *CLASHING]
        got = docs.collect()
        sizes.append(len(got))
        assert all(r[c] == (None if r["doc_id"] is None else f"{c}{r['doc_id']}") for r in got for c in CLASHING)
    assert sizes[:3] == [1032, 1032, 32] and 32 <= sizes[3] <= 64
    packed = pipeline.STAGES[-1][1](shared, docs, SF_DIR).collect()
    assert sum(r["piece"] == 0 for r in packed) == sizes[3]
