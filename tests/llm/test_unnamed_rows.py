"""Near duplicates among rows without an id and rows that share one, and the pipeline's stages
on odd and empty tables."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd_rows import ODD
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import ngram_join


def shingles(text):
    found = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(found[k:k + 5]) for k in range(max(1, len(found) - 4))} if found else set()


def groups(rows):
    """For each row the least position of the rows that it hangs together with, and its links."""
    sets = [shingles(text) for _, text in rows]
    links = defaultdict(set)
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) * 5 >= 4 * len(a | sets[j]):
                links[i].add(j)
                links[j].add(i)
    label = {}
    for i in range(len(rows)):
        todo = [i]
        while todo:
            at = todo.pop()
            if at not in label:
                label[at] = i
                todo += links[at]
    return label, links


def mixed(n):
    """A third of the rows without an id, a third with shared ids, near copies and repeats."""
    rng = np.random.default_rng(8)
    bases = [[f"w{b}x{k}" for k in range(40)] for b in range(n // 12)]
    rows = []
    for k in range(n):
        words = list(bases[int(rng.integers(len(bases)))])
        if rng.random() < 0.6:
            words[int(rng.integers(40))] = f"y{int(rng.integers(3))}"
        doc = None if k % 3 == 0 else k % 5 if k % 3 == 1 else 1000 + k
        rows.append((doc, " ".join(words)))
    return rows + [rows[3], rows[3], rows[4], rows[5], (None, None), (None, ""), (7, "?!"), (7, "?!")]


def test_links_of_rows_without_an_id_of_their_own(spark):
    rows = mixed(150)
    label, links = groups(rows)
    least = {}
    for i, root in label.items():
        doc = rows[i][0]
        least[root] = doc if least.get(root) is None else least[root] if doc is None else min(least[root], doc)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in ngram_join.near_duplicates(docs).collect())
    assert got == Counter((doc, least[label[i]], len(links[i])) for i, (doc, _) in enumerate(rows))


def test_one_row_of_each_group_stays(spark):
    rows = mixed(150)
    label, _ = groups(rows)
    docs = spark.createDataFrame([(i, t, n, "x") for n, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, digest int, `a.b` string").repartition(5)
    kept = ngram_join.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    stays = [r["digest"] for r in kept.collect()]
    assert sorted(label[n] for n in stays) == sorted(set(label.values()))
    by_group = {label[n]: rows[n][0] for n in stays}
    for root, doc in by_group.items():
        known = [rows[i][0] for i in label if label[i] == root and rows[i][0] is not None]
        assert doc == (min(known) if known else None)


@pytest.mark.parametrize("doc", ["NULL", "id", "id % 3"])
def test_many_near_copies_without_ids_take_no_more_rows(spark, doc):
    """The rows joined for verification do not depend on whether ids tell the copies apart."""
    body = " ".join(f"w{k}" for k in range(150))
    docs = spark.range(1200).selectExpr(f"CAST({doc} AS BIGINT) AS doc_id",
                                        f"concat('{body} z', id % 600, ' z', id % 600) AS text")
    out = ngram_join.near_duplicates(docs)
    assert out.count() == 1200 and out.where("n_links = 1199").count() == 1200
    assert ngram_join.without_near_duplicates(docs).count() == 1


STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture
def sf(spark, tmp_path):
    """Labels and documents of a folder of their own, with odd rows."""
    folder = str(tmp_path / "sf")
    source = "/root/testdata/sf0.001"
    spark.read.parquet(f"{source}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return folder


def odd_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in ODD], docs.schema)
    return docs.union(odd)


@pytest.mark.parametrize("name", ["quality", "language", "exact_dedup", "near_dedup", "packing"])
def test_stages_on_odd_and_empty_tables(spark, sf, name):
    stage = STAGES[name]
    docs = odd_documents(spark).withColumn("score", F.lit("mine"))
    out = stage(spark, docs, sf)
    if name == "packing":
        assert Counter(r["doc_id"] for r in out.where("start = 0").collect())[None] == 2
    else:
        assert out.columns == docs.columns
        rows = Counter((r["doc_id"], r["text"]) for r in out.collect())
        every = Counter((r["doc_id"], r["text"]) for r in docs.collect())
        assert rows <= every
        if name == "near_dedup":
            assert sum(n for (_, t), n in rows.items() if t and t.startswith("same text")) == 1
            assert rows[None, None] == 1 and rows[1, None] == 1 and rows[2, ""] == 1
        if name == "exact_dedup":
            assert {t or "" for _, t in rows} == {t or "" for _, t in every}
        if name == "language":
            assert not {t for _, t in rows} & {None, "", "   \n\t ", "!!! ### $$$"}
    assert stage(spark, docs.limit(0), sf).count() == 0


def test_the_pipeline_on_an_empty_table(spark, sf):
    docs = odd_documents(spark)
    docs.limit(0).write.parquet(f"{sf}/documents.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
