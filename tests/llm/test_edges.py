"""NULLs, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from odd_rows import ODD
from pyspark.sql import functions as F

from millrace.llm import (bpe_chunks, exact_dedup, fingerprint, html_text, language, line_dedup,
                          ngram_join, packing, quality, warc)

PATH = public_tokenizers.path("word_bpe_49k.json")
IDS = Counter(i for i, _ in ODD)


def ids_of(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_fingerprints(odd, empty):
    out = fingerprint.with_edited(odd)
    assert ids_of(out) == IDS
    rows = out.select("doc_id", "n_chars", "samples", "edited", fingerprint.likeness(
        F.col("samples"), F.col("edited_samples")).alias("near")).collect()
    by = {r["doc_id"]: r for r in rows}
    assert by[9]["samples"] == by[10]["samples"] == by[11]["samples"]
    assert by[2]["n_chars"] == 0 and list(by[2]["samples"]) == [] and by[2]["near"] == 1
    # Ids in order: none, -5, 1, 2, ...; after the last comes the first.
    assert by[12]["edited"] == "!!! ##" + "line\n"
    assert by[8]["edited"] == "x" * 35_000 + "same text in three rows, word for word"
    assert fingerprint.with_edited(empty).count() == 0


def test_fingerprint_of_one_document(spark):
    one = spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")
    row = fingerprint.with_edited(one).first()
    assert row["edited"] == "a b c d " + "a b c d"[:7] and row["next_samples"] == row["samples"]


def test_weights_matter(spark):
    """Samples agree as often as the weights are alike, not only the sets of terms."""
    a, b = "p q r s t " * 30, "p q r s t " * 3
    rows = [(k, f"w{k} " + a, f"w{k} " + b) for k in range(60)]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    near = df.select(F.avg(fingerprint.likeness(
        fingerprint.fingerprint(F.col("a")), fingerprint.fingerprint(F.col("b"))))).first()[0]
    assert near < 0.4


def test_encoding(odd, empty, library):
    coded = bpe_chunks.encode(odd, PATH)
    rows = bpe_chunks.decode(coded, PATH).collect()
    assert Counter(r["doc_id"] for r in rows) == IDS
    want = Counter()
    for doc, text in ODD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[doc, np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r["doc_id"], bytes(r["ids"]), r["text"]) for r in rows) == want
    both = bpe_chunks.encode(odd, PATH, decoded=True).collect()
    assert Counter((r["doc_id"], bytes(r["ids"]), r["text"]) for r in both) == want
    assert bpe_chunks.encode(empty, PATH).count() == 0


def test_one_document_in_very_many_rows(spark, library, monkeypatch):
    """Repeated rows, without an id and with one, beside rows that share text or id with them."""
    monkeypatch.setattr(bpe_chunks, "COPIES_AT_ONCE", 7)
    body = "the same words in many rows of one document, " * 40
    docs = spark.range(900).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 5 ELSE id END AS doc_id",
        f"CASE WHEN id % 9 = 2 THEN concat('{body}', id) WHEN id % 18 = 1 THEN NULL ELSE '{body}' END AS text")
    want = Counter()
    for row in docs.collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        want[row["doc_id"], np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)] += 1
    got = bpe_chunks.encode(docs.repartition(6), PATH, decoded=True).collect()
    assert Counter((r["doc_id"], bytes(r["ids"]), r["text"]) for r in got) == want and max(want.values()) == 300


def test_chunks_join_as_whole_texts(library):
    """Cuts anywhere, also within words and beside signs, leave the ids as they are."""
    from millrace.llm.encoder import Encoder

    enc, rng = Encoder(PATH), np.random.default_rng(3)
    signs = list("aabbcdeé ' .,!\n1") + [" the", "'s", "ing "]
    for _ in range(60):
        text = "".join(rng.choice(signs, 80))
        data = np.frombuffer(text.encode(), np.uint8)
        inside = np.flatnonzero((data & 0xC0) != 0x80)[1:]
        cuts = np.unique(rng.choice(inside, 6))
        bounds = np.concatenate([[0], cuts, [len(data)]])
        pieces = bpe_chunks.encode_chunks(enc, data, bounds[:-1], bounds[1:])
        got = np.frombuffer(bpe_chunks.join_pieces(enc, [pieces])[0], "<u4").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids


def test_cuts_depend_on_content_alone():
    rng = np.random.default_rng(5)
    passage = rng.integers(97, 123, 30_000).astype(np.uint8)
    lead = rng.integers(97, 123, 777).astype(np.uint8)
    one = bpe_chunks.cuts(passage, np.array([0, len(passage)]))[0]
    both = np.concatenate([lead, passage])
    two = bpe_chunks.cuts(both, np.array([0, len(both)]))[0] - len(lead)
    assert len(set(one) & set(two)) > 0.8 * len(one) > 10


def test_merkle_audit(spark):
    rows = [("f", k * 1000, f"record {k}") for k in range(500)] + [("g", 0, "only")]
    schema = "file string, offset long, length long, record string"
    digest = F.sha2("record", 256)
    original = warc.leaves(spark.createDataFrame([(f, o, len(r), r) for f, o, r in rows], schema)
                           .withColumn("digest", digest))
    hurt = [(f, o, r) for f, o, r in rows if o != 7000]
    hurt = [(f, o, "X" if o == 250_000 else r) for f, o, r in hurt] + [("f", 7500, "new"), ("h", 0, "file")]
    replica = warc.leaves(spark.createDataFrame([(f, o, len(r), r) for f, o, r in hurt], schema)
                          .withColumn("digest", digest))
    found = {(r["file"], r["offset"]): r["status"] for r in warc.audit(original, replica).collect()}
    assert found == {("f", 7000): "missing", ("f", 250_000): "changed", ("f", 7500): "extra",
                     ("h", 0): "extra"}
    assert warc.audit(original, original).count() == 0
    assert warc.audit(original.limit(0), replica.limit(0)).count() == 0


def test_warc_records(spark, folder):
    pages = spark.createDataFrame(
        [(1, "http://a/", "<p>é</p>", 5), (2, None, None, 6), (None, "u", "x" * 100_000, 7), (1, "http://a/", "<p>é</p>", 8)],
        "page_id long, url string, html string, record int")
    made = warc.records(pages)
    texts = {hashlib.sha256(r["record"].encode()).hexdigest(): r["record"] for r in made.collect()}
    rows = sorted(warc.manifest(warc.hashed(made)).collect(), key=lambda r: (r["file"], r["offset"]))
    assert len(rows) == 4 and len(texts) == 3
    at = 0
    for row in rows:
        assert row["offset"] == at and row["length"] == len(texts[row["digest"]].encode())
        at += row["length"]
    warc.write_archive(made, f"{folder}/out")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/out").collect()
    assert b"".join(bytes(f["content"]) for f in files) == "".join(texts[r["digest"]] for r in rows).encode()
    assert warc.records(pages.limit(0)).count() == 0


def test_pages_without_an_id_are_in_no_one_file(spark):
    pages = spark.range(3000).selectExpr("CAST(NULL AS BIGINT) AS page_id", "concat('http://', id) AS url", "'x' AS html")
    sizes = [r["count"] for r in warc.records(pages, 100).groupBy("file").count().collect()]
    assert len(sizes) == 30 and max(sizes) < 200


def test_packing(odd, empty, library):
    rows = packing.pack(odd, PATH).collect()
    totals = Counter()
    for row in rows:
        totals[row["doc_id"]] += row["length"]
    want = Counter()
    for doc, text in ODD:
        want[doc] += len(library.encode(text or "", add_special_tokens=False).ids) + 1
    assert totals == want
    assert packing.pack(empty, PATH).count() == 0


def test_differencing():
    assert [w[0] for w in packing.differencing([8, 7, 6, 5, 4], 2)] == [16, 14]  # as published
    rng = np.random.default_rng(1)
    for k in (1, 2, 7, 40):
        sizes = rng.integers(1, 500, 4 * k).tolist()
        windows = packing.differencing(sizes, k)
        assert sorted(i for _, inside in windows for i in inside) == list(range(len(sizes)))
        assert all(total == sum(sizes[i] for i in inside) for total, inside in windows)
    assert packing.balanced([], 10) == []
    assert len(packing.balanced([6, 6, 6], 10)) == 3  # one more than the sum asks for


def test_line_dedup(spark, empty):
    long = "A line of forty code points or more, it is."
    rows = [(k, f"own {k}\n  {long.upper()}\t\nend") for k in range(4)]
    rows += [(9, f"{long}\n{long}\nlast"), (9, "twin"), (None, long), (20, None), (21, ""),
             (22, ("short\n" * 30_000) + "x")]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, key string")
    got = Counter(tuple(r) for r in line_dedup.dedup_lines(docs).collect())
    want = Counter([(k, 3, 1, f"own {k}\nend") for k in range(4)])
    want += Counter([(9, 3, 0, f"{long}\n{long}\nlast"), (9, 1, 0, "twin"), (None, 1, 1, ""),
                     (20, 1, 0, ""), (21, 1, 0, ""), (22, 30_001, 0, rows[-1][1])])
    assert got == want
    bitmaps = {r["doc_id"]: list(r["keep_bitmap"])[:2] for r in line_dedup.keep_bitmaps(docs).collect()}
    assert bitmaps[0] == [1, 1] and bitmaps[None] == [0, 1]
    assert line_dedup.dedup_lines(empty).count() == 0


def test_unrelated_sketches_disagree():
    """However many shingles there are, values of unrelated sets agree by chance alone."""
    rng = np.random.default_rng(3)
    for n in (100, 5_000, 60_000):
        values = np.concatenate([np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for _ in range(4)])
        taken = ngram_join.sketches(values, np.arange(5) * n)[:, ngram_join.BANDS * 8:]
        agree = [(taken[a] == taken[b]).mean() for a in range(4) for b in range(a)]
        assert np.mean(agree) < 0.03


def test_every_label_is_learned(spark):
    """More labels than are fitted in full: the rare ones are learned and told too."""
    names = [f"l{k:03d}" for k in range(300)]
    rows = [(k * 4 + j, f"{chr(0x4E00 + 61 * k)}{chr(0x4E01 + 61 * k)} " * 20, name)
            for k, name in enumerate(names) for j in range(4 if k < 256 else 2)]
    taught = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = language.train(taught)
    assert network.languages == names
    told = {r["doc_id"]: r["lang_pred"] for r in language.identify(taught, network).collect()}
    rare = [told[doc] == name for doc, _, name in rows if name >= "l256"]
    assert np.mean(rare) > 0.9


def test_language(spark, odd, empty):
    taught = spark.createDataFrame(
        [(k, " ".join(["der und die"] * 9) if k % 2 else " ".join(["the and of"] * 9), "de" if k % 2 else "en")
         for k in range(40)] + [(99, "no label", None), (98, None, "de")], "doc_id long, text string, lang string")
    network = language.train(taught)
    assert network.languages == ["de", "en"]
    out = language.identify(odd, network)
    assert ids_of(out) == IDS
    by = {r["doc_id"]: r for r in out.collect()}
    assert all((by[k]["lang_pred"], by[k]["score"]) == ("und", 0) for k in (1, 2, 3, 12))
    assert all(r["lang_pred"] in ("de", "en", "und") and 0 <= r["score"] <= 1 for r in by.values())
    told = {r["doc_id"]: r["lang_pred"] for r in language.identify(taught, network).collect()}
    assert all(told[k] == ("de" if k % 2 else "en") for k in range(40))
    assert language.train(empty) is None and language.train(odd) is None
    assert {r["lang_pred"] for r in language.identify(odd, None).collect()} == {"und"}
    assert language.identify(empty, network).count() == 0
    assert language.accepted(odd, network, 0.3).columns == odd.columns


def test_quality(spark, odd, empty):
    docs = spark.createDataFrame(
        [(k, "fine words in a row." if k % 3 else "bad!!! words### in$$$ a&&& row") for k in range(90)],
        "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(90)] + [(None, 1), (5, None), (700, 0)],
                                   "doc_id long, quality int")
    model = quality.train(docs, labels)
    scores = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert all((scores[k] > 0.5) == (k % 3 > 0) for k in range(90))
    assert ids_of(quality.score(odd, model)) == IDS
    assert quality.score(empty, model).count() == 0
    unlearned = quality.train(docs, labels.limit(0))
    assert {r["score"] for r in quality.score(docs, unlearned).collect()} == {0.5}
    kept = quality.accepted(docs.withColumn("score", F.lit("s")), model)
    assert kept.columns == ["doc_id", "text", "score"] and kept.count() == 60


PAGE = """<html><head><title>T t</title><script>var x="</p>"</script></head><body>
<header><div>Name of the site, with a number of words</div></header>
<div id="content"><h1>Title &amp; x</h1><p>Text with <a href=x>a link</a> in it<br>and&nbsp;more
words.</p><aside>side bar words, many of them</aside><ul><li>one two three</li></ul>
<p>More text, 1 &lt; 2.</p><div class="cookie-notice">We use cookies and words</div><p>The end.</p>
<section class="comments"><p>The first comment is here and it is rather long.</p></section></div>
<form>Subscribe <input> now</form><footer>foot and more words of it</footer>"""


def test_html(spark):
    marked = [(k, "u", f"<nav><a href=1>menu {k}</a></nav><article><p>the text {k} of it</p></article>"
                       f"<footer>foot</footer>", None) for k in range(30)]
    more = [(50, None, None, 1), (51, "v", "", 1), (None, "w", "<p", 1), (52, "x", "a < b <3", 1),
            (53, "y", PAGE, 1), (53, "y", PAGE, 1), (54, "z", "<p>" + "word " * 100_000, 1)]
    pages = spark.createDataFrame(marked + more, "page_id long, url string, html string, text int")
    weights = html_text.train(pages)
    rows = html_text.main_text(pages, weights).collect()
    by = {r["page_id"]: r["text"] for r in rows}
    assert len(rows) == len(marked) + len(more)
    assert all(by[k] == f"the text {k} of it" for k in range(30))
    assert by[50] == by[51] == by[None] == "" and by[52] == "a < b <3"
    assert by[53] == ("Title & x\nText with a link in it and more words.\none two three\n"
                      "More text, 1 < 2.\nThe end.")
    assert by[54] == " ".join(["word"] * 100_000)
    assert html_text.main_text(pages.limit(0), html_text.train(pages.limit(0))).count() == 0


def test_exact_dedup(odd, empty):
    rows = exact_dedup.content_groups(odd).collect()
    assert Counter(r["doc_id"] for r in rows) == IDS
    for row in rows:
        same = [i for i, t in ODD if hashlib.sha256((t or "").encode()).hexdigest() == row["text_sha256"]]
        assert row["group_size"] == len(same)
        assert row["keep_id"] == max((i for i in same if i is not None), default=None)
    assert Counter(r["text_sha256"] for r in rows if r["kept"]) == Counter({r["text_sha256"] for r in rows})
    assert exact_dedup.kept_rows(odd).columns == odd.columns
    assert exact_dedup.content_groups(empty).count() == 0
    upper = exact_dedup.content_groups(odd, F.upper).collect()
    assert len(upper) == len(ODD)


def test_near_duplicates(odd, empty, spark):
    rows = ngram_join.near_duplicates(odd).collect()
    assert Counter(r["doc_id"] for r in rows) == IDS
    by = {r["doc_id"]: r for r in rows}
    assert by[11]["class_id"] == by[10]["class_id"] == by[9]["class_id"] == 9 and by[9]["n_links"] == 3
    assert all((by[k]["class_id"], by[k]["n_links"]) == (k, 0) for k in (1, 2, 3, 4, 12))
    assert ngram_join.near_duplicates(empty).count() == 0


def test_blocks_miss_no_link(spark, monkeypatch):
    """A bucket in many blocks gives the same links as in one."""
    rng = np.random.default_rng(4)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(120):
        words = list(base)
        words[int(rng.integers(60))] = f"x{k % 7}"
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(map(tuple, ngram_join.near_duplicates(docs).collect()))
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 8)
    assert sorted(map(tuple, ngram_join.near_duplicates(docs).collect())) == whole

    sets = [{tuple(t.split()[i:i + 5]) for i in range(56)} for _, t in rows]
    for k, (doc, _, _, n) in enumerate(whole):
        near = sum(len(sets[k] & s) * 5 >= 4 * len(sets[k] | s) for s in sets) - 1
        assert (doc, n) == (k, near)


@pytest.mark.parametrize("edges", [[], [(1, 2), (2, 3), (4, 5)], [(k, k + 1) for k in range(40)],
                                   [(0, k) for k in range(1, 60)] + [(99, 98)]])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "u long, v long")
    got = dict(map(tuple, ngram_join.components(df).collect()))
    label = {}
    for u, v in edges:
        a, b = label.setdefault(u, u), label.setdefault(v, v)
        label = {n: min(a, b) if x in (a, b) else x for n, x in label.items()}
    assert got == label
