"""The registered queries of this subpackage, each beside its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm import (bpe_chunks, decontaminate, exact_dedup, fingerprint, html_text, language, line_dedup,
                          ngram_join, packing, prefix_trie, quality, structure_repair, warc)
from millrace.sinks.files import staged

Query = Callable[[SparkSession, str], DataFrame]

# The vocabulary that the queries encode with; a path that all executors can open.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

ROOT = str(Path(__file__).resolve().parents[2])

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers import this package; on a cluster it is installed or sent by --py-files.
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query()
def op1_fingerprint(spark, sf_dir):
    out = fingerprint.with_edited(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint.text_of(F.col("samples")).alias("fingerprint"),
        fingerprint.text_of(F.col("edited_samples")).alias("edited_fingerprint"),
        fingerprint.likeness(F.col("samples"), F.col("edited_samples")).alias("near_edited"),
        fingerprint.likeness(F.col("samples"), F.col("next_samples")).alias("near_next"))


@query()
def op2_bpe_chunks(spark, sf_dir):
    return bpe_chunks.encode(table(spark, sf_dir, "documents"), TOKENIZER, decoded=True).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


# What befalls a page in the replica that is audited, by a digest of its id.
DAMAGE = {"changed": 1, "missing": 2, "cut": 3}
DAMAGE_OF = 64


@query(f"""
    WITH made AS (
        SELECT page_id, md5(page_id::VARCHAR) AS d, md5(page_id || ' ' || url) AS u,
               coalesce(html, '') AS block, url FROM pages),
    records AS (
        SELECT page_id, ('0x' || substr(d, 1, 8))::BIGINT
                   % greatest(1, (SELECT ceil(count(*) / 4096.0) FROM pages)::BIGINT) AS file,
               ('0x' || substr(d, 9, 8))::BIGINT % {DAMAGE_OF} AS damage,
               'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
               || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
               || 'WARC-Date: {warc.STAMP}' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:uuid:'
               || substr(u, 1, 8) || '-' || substr(u, 9, 4) || '-' || substr(u, 13, 4) || '-'
               || substr(u, 17, 4) || '-' || substr(u, 21, 12) || '>' || chr(13) || chr(10)
               || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: '
               || octet_length(encode(block)) || chr(13) || chr(10) || chr(13) || chr(10)
               || block || chr(13) || chr(10) || chr(13) || chr(10) AS record
        FROM made)
    SELECT page_id, file,
           (sum(octet_length(encode(record))) OVER (PARTITION BY file ORDER BY page_id)
            - octet_length(encode(record)))::BIGINT AS "offset",
           octet_length(encode(record)) AS length, sha256(record) AS sha256,
           CASE damage WHEN {DAMAGE['changed']} THEN 'changed' WHEN {DAMAGE['cut']} THEN 'changed'
                WHEN {DAMAGE['missing']} THEN 'missing' ELSE 'intact' END AS status
    FROM records""")
def op3_merkle_audit(spark, sf_dir):
    """The pages as an archive, and a replica of it in which some records are damaged."""
    made = warc.records(table(spark, sf_dir, "pages"))
    damage = F.conv(F.substring(F.md5(F.col("page_id").cast("string")), 9, 8), 16, 10).cast("long") % DAMAGE_OF
    hurt = (F.when(damage == DAMAGE["changed"], F.concat(F.lit("X"), F.expr("substring(record, 2)")))
            .when(damage == DAMAGE["cut"], F.expr("substring(record, 1, char_length(record) - 5)"))
            .otherwise(F.col("record")))
    # Both copies are hashed by the task that makes them; their texts go nowhere.
    rows = made.select(
        "page_id", "file", F.octet_length("record").cast("long").alias("length"),
        F.sha2("record", 256).alias("digest"), F.octet_length(hurt).cast("long").alias("hurt_length"),
        F.sha2(hurt, 256).alias("hurt_digest"),
        F.coalesce(damage == DAMAGE["missing"], F.lit(False)).alias("gone"))
    known = staged(warc.manifest(rows), "warc-manifest")
    replica = known.filter("NOT gone").select(
        "file", "offset", F.col("hurt_length").alias("length"), F.col("hurt_digest").alias("digest"))
    wrong = warc.audit(warc.leaves(known), replica)
    return known.join(wrong, ["file", "offset"], "left").select(
        "page_id", "file", "offset", "length", F.col("digest").alias("sha256"),
        F.coalesce("status", F.lit("intact")).alias("status"))


@query()
def op4_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


@query("""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS position
        FROM documents),
    keyed AS (
        SELECT doc_id, line, position, CASE WHEN length(key) >= 40 THEN key END AS key
        FROM (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
              FROM lines)),
    frequent AS (
        SELECT key, max(doc_id) AS keeper FROM keyed WHERE key IS NOT NULL
        GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    marked AS (
        SELECT doc_id, line, position, keeper IS NOT NULL AND doc_id <> keeper AS goes
        FROM keyed LEFT JOIN frequent USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE goes) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE NOT goes), ''))
               AS kept_sha256
    FROM marked GROUP BY doc_id""")
def op5_line_dedup(spark, sf_dir):
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2("kept_text", 256).alias("kept_sha256"))


def fold(folds: int) -> Column:
    """A number below ``folds`` that depends on the id alone."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def language_network(docs: DataFrame) -> language.Network | None:
    return language.train(docs.filter(fold(4) != 2))


@query()
def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language_network(docs)).select(
        "doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query()
def op7_html_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return html_text.main_text(pages, html_text.train(pages)).withColumn(
        "n_chars", F.char_length("text").cast("long"))


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Model:
    return quality.train(docs, labels.filter(fold(5) != 0))


@query()
def op8_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query("""
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""")
def op9_exact_dedup(spark, sf_dir):
    return exact_dedup.content_groups(table(spark, sf_dir, "documents"))


@query()
def op10_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


ASCII_LOWER = f"'{line_dedup.UPPER}', '{line_dedup.LOWER}'"


@query(f"""
    WITH items AS (
        SELECT item_id, regexp_extract_all(translate(text, {ASCII_LOWER}), '{decontaminate.WORD}') AS w
        FROM benchmark WHERE text IS NOT NULL),
    windows AS (
        SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, p, p + least(len(w), 10) - 1) AS part
        FROM items, LATERAL (SELECT unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p) WHERE len(w) > 0),
    docs AS (
        SELECT doc_id, coalesce(regexp_extract_all(translate(text, {ASCII_LOWER}), '{decontaminate.WORD}'),
                                []) AS w FROM documents),
    places AS (
        SELECT doc_id, p, n, list_slice(w, p, p + n - 1) AS part
        FROM docs, (SELECT DISTINCT n FROM windows),
             LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS p)),
    found AS (SELECT doc_id, p, places.n, item_id FROM places JOIN windows USING (part)),
    hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit
            FROM found, LATERAL (SELECT unnest(range(p, p + n)) AS place) GROUP BY doc_id),
    named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, coalesce(item_id::VARCHAR, '') AS item FROM found) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""")
def op12_decontaminate(spark, sf_dir):
    marked = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of a short ASCII text: each byte, then seven zeros, by one step a bit."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda c: [unicode(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor(xor(crc, bit) >> 1, (xor(crc, bit) & 1) * 3988292384)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda crc, bit: {step}), 4294967295)"


# What befalls a turn, by the remainder of a checksum of its conversation and number.
DAMAGE_TURNS = 20
DROPPED, EMPTIED, UNENDED, REPEATED, REROLED = range(5)


def damaged(turns: DataFrame) -> DataFrame:
    """The turns after the damage that their conversation and number ask for."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = turns.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")],
                        (F.crc32(key.cast("binary")) % DAMAGE_TURNS).alias("damage")).filter(F.col("damage") != DROPPED)
    damage = F.col("damage")
    text = (F.when(damage == EMPTIED, "").when(damage == UNENDED, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    return rows.select(
        "conv_id", "turn", F.when(damage == REROLED, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.explode(F.sequence(F.lit(1), F.when(damage == REPEATED, 2).otherwise(1)))).drop("col")


def _dp_sql() -> dict[str, str]:
    """The steps of the repair in SQL. Each state holds a struct of cost, audit and lines, of
    which the least one by cost and audit is kept."""
    def then(state: str, cost: str, letter: str, line: str = "", when: str = "true") -> str:
        out = f"list_append({state}.lines, {line})" if line else f"{state}.lines"
        return (f"CASE WHEN {state} IS NOT NULL AND {when} THEN "
                f"{{'cost': {state}.cost + {cost}, 'audit': {state}.audit || '{letter}', 'lines': {out}}} END")

    def least(*cells: str) -> str:
        return f"list_min([{', '.join(cells)}])"

    def inserted(source: str) -> str:
        user = [then(f"c{k}", "5", "I", "'user:'") for k in (0, 1, 3)]
        return (f"SELECT * REPLACE ({least('c2', *user)} AS c2, "
                f"{least('c3', then('c2', '5', 'I', chr(39) + 'assistant:' + chr(39)))} AS c3) FROM ({source})")

    def kept(state: str, initial: str) -> str:
        return then(state, "cut", "K", "role || ':' || text", f"NOT gone AND initial = '{initial}'")

    def reroled(state: str, role: str) -> str:
        return then(state, "1 + cut", "R", f"'{role}:' || text", "NOT gone")

    deleted = [then(f"c{k}", "2", "D") for k in range(4)]
    user = [cell for k in (0, 1, 3) for cell in (kept(f"c{k}", "u"), reroled(f"c{k}", "user"))]
    edited = {"c0": deleted[0], "c1": least(deleted[1], kept("c0", "s")), "c2": least(deleted[2], *user),
              "c3": least(deleted[3], kept("c2", "a"), reroled("c2", "assistant"))}
    cells = ", ".join(f"{cell} AS {name}" for name, cell in edited.items())
    step = "SELECT conv, nth, c0, c1, c2, c3, initial, gone, cut, role, text FROM dp JOIN faults USING (conv, nth)"
    return {"step": f"SELECT conv, nth + 1 AS nth, {cells} FROM ({inserted(inserted(step))})",
            "ended": inserted(inserted("SELECT * FROM dp"))}


_DP = _dp_sql()
_CELL = "STRUCT(cost BIGINT, audit VARCHAR, lines VARCHAR[])"


@query(f"""
    WITH RECURSIVE damage AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS d
        FROM conversations),
    hurt AS (
        SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
               CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM damage, range(2) AS copy (c) WHERE d <> 0 AND (c = 0 OR d = 3)),
    convs AS (SELECT conv_id, row_number() OVER () AS conv FROM (SELECT DISTINCT conv_id FROM conversations)),
    placed AS (
        SELECT conv, turn, role, text, substr(role, 1, 1) AS initial,
               row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, digest) - 1 AS nth,
               regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
        FROM (SELECT *, md5(octet_length(encode(role)) || ':' || role || text) AS digest FROM hurt) AS h
             JOIN convs ON h.conv_id IS NOT DISTINCT FROM convs.conv_id),
    repeated AS (SELECT *, nth > min(nth) OVER (PARTITION BY conv, role, text) AS again FROM placed),
    faults AS (
        SELECT *, last = '' OR again AS gone,
               CASE WHEN last <> '' AND NOT again AND last NOT IN ('.', '!', '?') THEN 5 ELSE 0 END AS cut,
               lag(initial) OVER (PARTITION BY conv ORDER BY nth) AS before FROM repeated),
    counts AS (
        SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (WHERE last = '') AS blank, count(*) FILTER (WHERE last <> '' AND again) AS duplicate,
               count(*) FILTER (WHERE cut > 0) AS truncated, count(*) AS n,
               count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
        FROM faults GROUP BY conv),
    dp AS (
        SELECT conv, 0::BIGINT AS nth, {{'cost': 0, 'audit': '', 'lines': []}}::{_CELL} AS c0, NULL::{_CELL} AS c1,
               NULL::{_CELL} AS c2, NULL::{_CELL} AS c3 FROM convs
        UNION ALL {_DP['step']}),
    best AS (
        SELECT conv, nth, list_min([c0, c3]) AS best FROM ({_DP['ended']}))
    SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost AS cost,
           best.audit AS audit, sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256
    FROM convs LEFT JOIN counts USING (conv) JOIN best USING (conv) WHERE nth = coalesce(n, 0)""")
def op13_structure_repair(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return structure_repair.repair_report(damaged(turns), turns)


# A conversation begins with so many turns of the first one of its hundred, by its checksum.
SHARED_TURNS, SHARED_AMONG = 6, 100


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of every conversation behind the first ones of its hundred's, and all ids."""
    own = staged(prefix_trie.ordered_turns(turns), "ordered-turns")
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED_TURNS).alias("taken")
    ids = staged(own.select("conv_id").distinct().select("conv_id", taken), "conversation-ids")
    first = own.filter((F.col("conv_id") % SHARED_AMONG == 0) & (F.col("nth") < SHARED_TURNS)).withColumnRenamed(
        "conv_id", "base")
    begun = (ids.withColumn("base", F.col("conv_id") - F.col("conv_id") % SHARED_AMONG).join(first, "base")
             .filter("nth < taken").select("conv_id", "nth", "digest", "length"))
    rest = own.filter(F.col("nth") >= taken)
    return begun.unionByName(rest), ids


@query(f"""
    WITH original AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
                   PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(
                       octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) AS nth
        FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (SELECT conv_id, {crc32_sql('conv_id::VARCHAR')} % 6 AS h FROM (SELECT DISTINCT conv_id FROM original)),
    turns AS (
        SELECT c.conv_id, 0 AS part, nth, role, text
        FROM convs AS c JOIN original AS o ON o.conv_id = c.conv_id - c.conv_id % 100 AND nth <= h
        UNION ALL SELECT conv_id, 1, nth, role, text FROM original JOIN convs USING (conv_id) WHERE nth > h),
    lists AS (
        SELECT conv_id, coalesce(said, []) AS said FROM convs LEFT JOIN (
            SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY part, nth) AS said
            FROM turns GROUP BY conv_id) USING (conv_id)),
    paths AS (
        SELECT conv_id, d AS depth, sha256(list_slice(said, 1, d)::VARCHAR || d) AS name, d = len(said) AS ends,
               CASE WHEN d > 0 THEN length(said[d].text) ELSE 0 END AS last
        FROM lists, LATERAL (SELECT unnest(range(0, len(said) + 1)) AS d)),
    nodes AS (
        SELECT name, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n, any_value(last) AS last,
               sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
        FROM paths GROUP BY name),
    parents AS (
        SELECT nodes.*, up.name AS parent FROM nodes
               LEFT JOIN paths AS up ON up.conv_id = nodes.conv_id AND up.depth = nodes.depth - 1),
    children AS (SELECT parent AS name, count(*) AS n_children FROM parents WHERE parent IS NOT NULL GROUP BY parent),
    counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (name)),
    sums AS (
        SELECT up.name, sum((n - 1) * counted.last) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
        FROM counted JOIN paths AS up ON up.conv_id = counted.conv_id AND up.depth <= counted.depth GROUP BY up.name)
    SELECT node.conv_id, node.depth, up.conv_id AS parent_conv_id, node.n AS n_convs, counted.n_children,
           leaves AS n_leaves, saved::BIGINT AS saved_tokens, node.ends_sha256
    FROM parents AS node JOIN counted USING (name) JOIN sums USING (name) LEFT JOIN nodes AS up ON up.name = node.parent""")
def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(*rebuilt(table(spark, sf_dir, "conversations")))
