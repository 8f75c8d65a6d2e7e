"""The registered queries on the small tables: against their SQL, or against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm.queries import QUERIES, SQL

TABLES = "/root/testdata/sf0.001"


def collected(df, *order):
    return sorted((row.asDict() for row in df.collect()), key=lambda r: [r[c] for c in order])


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, TABLES)
    expected = duck.execute(SQL[name])
    names = [c[0] for c in expected.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted(tuple(map(str, row)) for row in expected.fetchall())
    assert sorted(tuple(map(str, row)) for row in got.select(*names).collect()) == want


def shingles(text):
    found = re.findall(r"[^\W_]+", text.lower())
    return Counter(tuple(found[k:k + 5]) for k in range(max(1, len(found) - 4))) if found else Counter()


def alike(a, b):
    keys = set(a) | set(b)
    return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys) if keys else 1.0


def test_op1(spark, documents):
    got = collected(QUERIES["op1_fingerprint"](spark, TABLES), "doc_id")
    assert [r["doc_id"] for r in got] == [i for i, _ in documents]
    prints, off_edited, off_next = defaultdict(set), [], []
    for k, (row, (_, text)) in enumerate(zip(got, documents)):
        following = documents[(k + 1) % len(documents)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == sha(edited)
        prints[text].add(row["fingerprint"])
        if text == edited:
            assert row["near_edited"] == 1
        off_edited.append(row["near_edited"] - alike(shingles(text), shingles(edited)))
        off_next.append(row["near_next"] - alike(shingles(text), shingles(following)))
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
    assert all(len(p) == 1 for p in prints.values())
    assert abs(np.mean(off_edited)) < 0.02 and np.std(off_edited) < 0.08
    assert np.abs(off_next).max() < 0.1


def test_op1_repeats(spark):
    """Texts in which shingles repeat, each on its own against its own likeness."""
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    texts = [(r["doc_id"], r["text"] or "") for r in rows]
    got = {r["doc_id"]: r["near_edited"] for r in QUERIES["op1_fingerprint"](spark, folder).collect()}
    off = {}
    for k, (doc, text) in enumerate(texts):
        own, half = shingles(text), len(text) // 2
        if 700 <= len(text) <= 20_000 and max(own.values(), default=0) > 3:
            edited = text[:len(text) - half] + texts[(k + 1) % len(texts)][1][:half]
            off[doc] = abs(got[doc] - alike(own, shingles(edited)))
    assert len(off) > 50 and {413, 534, 730, 856} <= set(off)
    assert max(off.values()) < 0.2 and np.mean(list(off.values())) < 0.05


def test_op2(spark, documents, library):
    got = collected(QUERIES["op2_bpe_chunks"](spark, TABLES), "doc_id")
    for row, (doc, text) in zip(got, documents, strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        assert (row["doc_id"], row["n_tokens"]) == (doc, len(ids))
        assert row["ids_sha256"] == sha(np.array(ids, "<u4").tobytes())
        assert row["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))


def test_op4(spark, documents, library):
    got = QUERIES["op4_packing"](spark, TABLES).collect()
    of = defaultdict(list)
    for row in got:
        of[row["doc_id"]].append(row)
    for doc, text in documents:
        ids, at = library.encode(text, add_special_tokens=False).ids + [1], 0
        for row in sorted(of[doc], key=lambda r: r["start"]):
            part = np.array(ids[at:at + row["length"]], "<u4").tobytes()
            assert (row["start"], row["doc_tokens"], row["ids_crc32"]) == (at, len(ids), zlib.crc32(part))
            at += row["length"]
        assert at == len(ids)
    sequences = defaultdict(list)
    for row in got:
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
    total = sum(row["length"] for row in got)
    assert len(sequences) * 2048 < total * 1.03


def held(doc, folds, rest):
    return zlib.crc32(str(doc).encode()) % folds == rest


def test_op6(spark):
    got = collected(QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01"), "doc_id")
    truth = {r["doc_id"]: r["lang"] for r in
             spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    assert len(got) == len(truth)
    assert all(r["held_out"] == held(r["doc_id"], 4, 2) and 0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in got if r["held_out"]]) > 0.97


def test_op8(spark):
    folder = "/root/testdata/sf0.1"
    got = collected(QUERIES["op8_quality"](spark, folder), "doc_id")
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(r["held_out"] == held(r["doc_id"], 5, 0) and 0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got)
    known = [(r["score"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    good, bad = ([s for s, q in known if q == k] for k in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.99
    assert np.mean([(s >= 0.3) == q for s, q in known]) > 0.98


def test_op7(spark):
    import html

    def main(page):
        blocks = re.split(r"</?(?:p|h1)>", page[page.index("<article>") + 9:page.index("</article>")])
        plain = (re.sub(r"</?b>", "", block).replace("<br>", " ") for block in blocks)
        return "\n".join(filter(None, (" ".join(html.unescape(block).split()) for block in plain)))

    pages = {r["page_id"]: r for r in spark.read.parquet(f"{TABLES}/pages.parquet").collect()}
    got = QUERIES["op7_html_text"](spark, TABLES).collect()
    assert len(got) == len(pages)
    for row in got:
        assert row["text"] == main(pages[row["page_id"]]["html"]) and row["n_chars"] == len(row["text"])
        assert row["url"] == pages[row["page_id"]]["url"]


def plain_links(documents):
    sets = {doc: set(shingles(text)) for doc, text in documents}
    holders, common = defaultdict(list), Counter()
    for doc, own in sets.items():
        for shingle in own:
            common.update((other, doc) for other in holders[shingle])
            holders[shingle].append(doc)
    links = defaultdict(set)
    for (a, b), n in common.items():
        if n * 5 >= 4 * (len(sets[a]) + len(sets[b]) - n):
            links[a].add(b)
            links[b].add(a)
    label = {}
    for doc in sorted(sets):
        reached = [doc]
        while reached:
            at = reached.pop()
            if at not in label:
                label[at] = label.get(doc, doc) if at != doc else doc
                reached += links[at]
    return links, label


def test_op10(spark, documents):
    links, label = plain_links(documents)
    got = collected(QUERIES["op10_ngram_join"](spark, TABLES), "doc_id")
    assert [(r["doc_id"], r["n_links"], r["class_id"]) for r in got] == [
        (doc, len(links[doc]), label[doc]) for doc, _ in documents]


def test_pipeline(spark, documents):
    """Each stage on what the stage before it kept."""
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    columns, before = docs.columns, dict(documents)
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, TABLES).cache()
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert all(before[doc] == text for doc, text in after.items())
        if name == "quality":
            scores = {r["doc_id"]: r["predicted"] for r in QUERIES["op8_quality"](spark, TABLES).collect()}
            assert set(after) == {doc for doc in before if scores[doc]}
        if name == "exact_dedup":
            largest = {text: doc for doc, text in sorted(before.items())}
            assert set(after) == set(largest.values())
        if name == "near_dedup":
            label = plain_links(sorted(before.items()))[1]
            assert set(after) == {doc for doc in before if label[doc] == doc}
        before = after
    pieces = corpus_pipeline.STAGES[4][1](spark, docs, TABLES)
    assert {r["doc_id"] for r in pieces.collect()} == set(before)
    assert corpus_pipeline.run(spark, TABLES).count() == pieces.count()


def test_pipeline_language(spark):
    """The stage keeps exactly the rows that identify tells with the certainty asked for."""
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text", "lang")
    rng = np.random.default_rng(5)
    odd = [(10**6 + k, "".join(chr(c) for c in rng.integers(0x430, 0x450, 1_000)), None) for k in range(50)]
    docs = docs.union(spark.createDataFrame(odd + [(10**7, "12 34 !?", None)], docs.schema)).cache()
    network = corpus_pipeline.language_network(docs)
    told = corpus_pipeline.language.identify(docs, network).collect()
    least = 1 / 4 + (1 - 1 / 4) / 3
    want = {r["doc_id"] for r in told if r["lang_pred"] != "und" and r["score"] >= least}
    got = {r["doc_id"] for r in corpus_pipeline.known_language(spark, docs, TABLES).collect()}
    assert len(network.languages) == 4 and got == want
    foreign = {doc for doc, _, _ in odd}
    loose = {r["doc_id"] for r in told if r["score"] >= 0.3}
    assert len(got & foreign) < len(loose & foreign) and 10**7 not in got
    assert got - foreign == {r["doc_id"] for r in told} - foreign - {10**7}


def test_pipeline_packing(spark, documents, library):
    """The pieces of the last stage cover each document that reaches it."""
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    of = defaultdict(list)
    for row in corpus_pipeline.packed(spark, docs, TABLES).collect():
        of[row["doc_id"]].append(row)
    assert set(of) == {doc for doc, _ in documents}
    for doc, text in documents:
        ids, at = library.encode(text, add_special_tokens=False).ids + [1], 0
        for row in sorted(of[doc], key=lambda r: r["start"]):
            part = np.array(ids[at:at + row["length"]], "<u4").tobytes()
            assert (row["start"], bytes(row["ids"])) == (at, part)
            at += row["length"]
        assert at == len(ids)
