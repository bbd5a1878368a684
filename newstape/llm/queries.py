"""The registered query of each operator, with its SQL where SQL can express it."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newstape.llm import (
    chat, decontam, embeddings, ffd, lines, merkle, packing, quality, runs, secretscan, simhash, suffixes, warc,
)
from newstape.llm.common import id_back, mapped, rows, table, text_of

#: share of label 1 above which a document passes
PASS = 0.3


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secretscan.scan(docs, secretscan.train(docs))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, base, spans = [], [], []
        for some in batch.column("spans").to_pylist():
            ruled = [x for x in some if x["kind"] != "learned"]
            counts.append([sum(x["kind"] == k for x in ruled) for k in secretscan.KINDS[:3]])
            named, all_ = (",".join(f"{x['kind']}:{x['start']}:{x['end']}" for x in part) for part in (ruled, some))
            base.append(hashlib.sha256(named.encode()).hexdigest())
            spans.append(all_)
        assign, access, hexes = (pa.array(c, pa.int64()) for c in zip(*counts))
        return rows(doc_id=batch.column("doc_id"), n_assign=assign, n_access=access, n_hex=hexes, base_sha256=base, spans=spans)

    return mapped(found, each, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


#: the conversation added to those of the table
ADDED = (-7, r"\### Assistant: </turn> ok")


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv, said = ADDED
    extra = [(conv, 0, "user", said), (conv, 1, "assistant", said)]
    turns = turns.unionByName(spark.createDataFrame(extra, "conv_id long, turn long, role string, text string"))
    pieces = chat.format_conversations(turns)
    ordered = pieces.repartition("_id").sortWithinPartitions("_id", "_range", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None  # conversation, turns, digest of turns, loss characters, loss digest, characters
        done: list[list] = []

        def out():
            ids, n, turns_digest, loss, loss_digest, letters = zip(*done)
            done.clear()
            return rows(
                _id=pa.array(ids, pa.int64()), n_turns=pa.array(n, pa.int64()), turns_sha256=[d.hexdigest() for d in turns_digest],
                loss_chars=pa.array(loss, pa.int64()), loss_sha256=[d.hexdigest() for d in loss_digest],
                formatted_chars=pa.array(letters, pa.int64()),
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("_id", "formatted", "loss_start", "loss_end")]
            for conv, text, starts, ends in zip(*columns):
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(state)
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in chat.parsed(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                for a, b in zip(starts, ends):
                    learnt = chat.unescaped(text[a:b])
                    state[3] += len(learnt)
                    state[4].update(learnt.encode())
                state[5] += len(text)
            if len(done) >= 2000:
                yield out()
        if state is not None:
            done.append(state)
        if done:
            yield out()

    schema = "_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    read = ordered.mapInArrow(run, schema)
    return read.select(id_back().alias("conv_id"), *[c.split()[0] for c in schema.split(", ")[1:]])


OP2_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
    SELECT *,
        length(text) + length(text) - length(replace(text, '\', ''))
            + len(list_filter(range(1, length(text) - 1), lambda i: substr(text, i, 3) = '###'))
            + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS escaped,
        length(role) + length(role) - length(replace(replace(role, '\', ''), chr(10), '')) AS named
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(4 + named + 1 + escaped + 8)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.linked(table(spark, sf_dir, "embeddings"))


OP3_SQL = """
WITH RECURSIVE good AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
    SELECT a.vec_id AS u, b.vec_id AS v FROM good a JOIN good b
      ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
    SELECT vec_id AS u, vec_id AS v FROM embeddings
    UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u
), component AS (
    SELECT u AS vec_id, min(v) AS component_id FROM reach GROUP BY u
), degree AS (
    SELECT u AS vec_id, count(*) AS n_links FROM link GROUP BY u
)
SELECT c.vec_id, coalesce(d.n_links, 0) AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM component c LEFT JOIN degree d ON c.vec_id = d.vec_id
"""


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    sizes = F.transform(F.coalesce("_spans", F.array()), lambda s: s["end"] - s["begin"])
    return left.select(
        "doc_id", F.octet_length(text_of()).cast("long").alias("n_bytes"),
        F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
        F.size(sizes).cast("long").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256"),
    )


def sized(docs: DataFrame) -> DataFrame:
    """Documents with their length class, the metadata the quality score may use."""
    return docs.withColumn("size_class", F.floor(F.log2(F.col("n_chars") + F.lit(1.0))))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = sized(table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars"))
    model = quality.train(docs, table(spark, sf_dir, "labels"), metadata=("size_class",))
    scored = quality.score(docs, model, metadata=("size_class",))
    return scored.select(
        "doc_id",
        (quality.remainder() == 0).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= PASS).cast("int").alias("predicted"),
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    manifest = warc.write_archives(pages, warc.archive_folder(pages))
    read = warc.read_archives(manifest)
    sound = F.when(F.col("valid"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("a record fails its digest")))
    return read.select("page_id", "payload_bytes", sound.alias("payload_digest"), "record_type", "refers_to")


OP6_SQL = """
WITH page AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS digest FROM pages
), ranked AS (
    SELECT *, max(page_id) OVER (PARTITION BY digest) AS keeper FROM page
)
SELECT page_id, payload_bytes,
    array_to_string(list_transform(range(8), lambda g:
        array_to_string(list_transform(range(4), lambda k:
            substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   (((('0x' || substr(digest, g * 5 + 1, 5))::BIGINT >> (15 - 5 * k)) & 31) + 1)::BIGINT, 1)), '')), '') AS payload_digest,
    CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM ranked
"""


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(id_back().alias("doc_id"), "item_id", "edits", "first_word", "n_words")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
        F.sha2(text_of().cast("binary"), 256).alias("kept_sha256"),
    )


OP8_SQL = r"""
WITH line AS (
    SELECT doc_id, t.n AS pos, t.line AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents) d,
         unnest(l) WITH ORDINALITY AS t(line, n)
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM line
), common AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), flagged AS (
    SELECT k.doc_id, k.pos, k.line, (c.key IS NOT NULL AND k.doc_id <> c.keeper) AS gone
    FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
"""


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def number_hash() -> Column:
    """CRC-32 of the decimal ``doc_id``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    tampered = F.when(F.pmod(number_hash(), F.lit(7)) == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = merkle.manifest(docs, claimed={"n_chars": tampered})
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.concat_ws("", "proof").cast("binary"), 256).alias("proof_sha256"),
        "folded_root", "verified",
    )


#: CRC-32 of the decimal doc_id, bit by bit
SQL_NUMBER_HASH = """xor(4294967295, list_reduce(
    list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a // 2, 3988292384 * (a % 2))), 4294967295))"""

OP11_SQL = f"""
WITH RECURSIVE plain AS (
    SELECT doc_id, lang, n_chars,
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') AS head,
        coalesce(strlen(text) || ':' || text, '-') AS body,
        n_chars + CASE WHEN {SQL_NUMBER_HASH} % 7 = 0 THEN 1 ELSE 0 END AS n_claimed
    FROM documents
), leaf AS MATERIALIZED (
    SELECT doc_id, coalesce('1' || lang, '0') AS lang,
        sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || body) AS hash,
        sha256(head || coalesce(strlen(n_claimed::VARCHAR) || ':' || n_claimed, '-') || body) AS claim
    FROM plain
), placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, hash) - 1 AS place FROM leaf
), node AS (
    SELECT lang, 0 AS level, place, hash, count(*) OVER (PARTITION BY lang) AS n FROM placed
    UNION ALL
    SELECT lang, any_value(level) + 1, place // 2, sha256(string_agg(hash, '' ORDER BY place)), (any_value(n) + 1) // 2
    FROM node WHERE n > 1 GROUP BY lang, place // 2
), tree AS MATERIALIZED (
    SELECT * FROM node
), subroot AS MATERIALIZED (
    SELECT lang, hash, row_number() OVER (ORDER BY lang) - 1 AS top, level AS height FROM tree WHERE n = 1
), upper AS (
    SELECT 0 AS level, top AS place, hash, count(*) OVER () AS n FROM subroot
    UNION ALL
    SELECT any_value(level) + 1, place // 2, sha256(string_agg(hash, '' ORDER BY place)), (any_value(n) + 1) // 2
    FROM upper WHERE n > 1 GROUP BY place // 2
), crown AS MATERIALIZED (
    SELECT * FROM upper
), place AS MATERIALIZED (
    SELECT p.doc_id, p.lang, p.place, p.hash, p.claim, s.hash AS subroot, s.top, s.height,
        (SELECT hash FROM crown WHERE n = 1) AS root, (SELECT max(level) FROM crown) AS crown_height
    FROM placed p JOIN subroot s ON p.lang = s.lang
), fold AS (
    SELECT lang, place, 0 AS step, claim AS node, '' AS proof FROM place
    UNION ALL
    SELECT f.lang, f.place, f.step + 1,
        CASE WHEN f.step < p.height THEN
            CASE WHEN t.hash IS NULL THEN sha256(f.node) WHEN (f.place >> f.step) & 1 = 1 THEN sha256(t.hash || f.node) ELSE sha256(f.node || t.hash) END
        ELSE
            CASE WHEN c.hash IS NULL THEN sha256(f.node) WHEN (p.top >> (f.step - p.height)) & 1 = 1 THEN sha256(c.hash || f.node) ELSE sha256(f.node || c.hash) END
        END,
        f.proof || coalesce(t.hash, c.hash, '')
    FROM fold f JOIN place p ON f.lang = p.lang AND f.place = p.place
    LEFT JOIN tree t ON f.step < p.height AND t.lang = f.lang AND t.level = f.step AND t.place = xor(f.place >> f.step, 1)
    LEFT JOIN crown c ON f.step >= p.height AND c.level = f.step - p.height AND c.place = xor(p.top >> greatest(0, f.step - p.height), 1)
    WHERE f.step < p.height + p.crown_height
)
SELECT p.doc_id, p.hash AS leaf, p.subroot, p.root, sha256(f.proof) AS proof_sha256, f.node AS folded_root, f.node = p.root AS verified
FROM place p JOIN fold f ON p.lang = f.lang AND p.place = f.place AND f.step = p.height + p.crown_height
"""

def op12_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ffd.packed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's repetitions: documents with h % 10 = 0 repeat a stretch of their words to their end."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = runs.periodic_runs(docs, edit=planted)
    # of equal exponents the first stays: runs come by start, then period
    best = F.expr("""aggregate(_runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>),
        (a, x) -> CASE WHEN a IS NULL OR x.length * a.period > a.length * x.period THEN x ELSE a END)""")
    listed = F.transform("_runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("_runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", listed).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("_collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict = {
    "op1_secrets": (op1_secrets, None),
    "op2_chat": (op2_chat, OP2_SQL),
    "op3_embeddings": (op3_embeddings, OP3_SQL),
    "op4_suffix_dedup": (op4_suffix_dedup, None),
    "op5_quality": (op5_quality, None),
    "op6_warc": (op6_warc, OP6_SQL),
    "op7_decontaminate": (op7_decontaminate, None),
    "op8_line_dedup": (op8_line_dedup, OP8_SQL),
    "op9_pack": (op9_pack, None),
    "op10_simhash": (op10_simhash, None),
    "op11_manifest": (op11_manifest, OP11_SQL),
    "op12_pack": (op12_pack, None),
    "op13_runs": (op13_runs, None),
}
