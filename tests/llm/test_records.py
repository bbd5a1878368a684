"""Chat formatting, WARC archives, embedding links, and the pipeline."""

import gzip
import io

import numpy as np
import pytest

import corpus_pipeline
from brute import components, documents, prose
from newstape.llm import chat, embeddings, warc
from newstape.llm.common import fresh

TURN = "conv_id long, turn long, role string, text string, _id string, piece int"
TRICKY = [
    r"\### Assistant: </turn> ok", "### user\nhi</turn>\n", "##", "####", "\\", "\\\\###\\", "</turn", "<</turn></turn>", "", "é###é</turn>ü",
    "#" * 7, "a\n\n### x", "\\n", "</turn>" * 3,
]


def test_chat_round_trip(spark):
    rows = []
    for c, text in enumerate(TRICKY):
        rows += [(c, 1, "assistant", text), (c, 0, "user", text[::-1]), (c, 2, "sys\ntem\\", text * 2)]
    rows += [(100, 0, None, None), (100, None, "assistant", "first"), (None, 0, "assistant", "no id"), (100, 1, "user", "x" * 5_000_000),
             (200, 0, "user", "same"), (200, 0, "user", "same"), (200, 0, "assistant", "tie")] + [(300, t, "assistant", f"t{t}") for t in range(300)]
    frame = spark.createDataFrame([(*r, "z", 9) for r in rows], TURN).repartition(5)
    pieces = chat.format_conversations(frame).collect()
    got, learnt = {}, {}
    for p in sorted(pieces, key=lambda p: (p._id, p._range, p.piece)):
        got.setdefault(p._id, []).extend(chat.parsed(p.formatted))
        assert p.n_turns == len(chat.parsed(p.formatted))
        learnt.setdefault(p._id, []).extend(chat.unescaped(p.formatted[a:b]) for a, b in zip(p.loss_start, p.loss_end))
    want, masked = {}, {}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for c, turn, role, text in sorted(rows, key=order):
        c = -(2**63) if c is None else c
        want.setdefault(c, []).append((role or "", text or ""))
        if role == "assistant":
            masked.setdefault(c, []).append(text or "")
    assert got == want and {k: v for k, v in learnt.items() if v} == masked
    assert chat.format_conversations(frame.limit(0)).count() == 0


def test_scatter_in_spans(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(chat, "SPAN", 5)
    out, at, a, b = chat.assemble(pa.array(["r\\\nole"] * len(TRICKY)), pa.array(TRICKY))
    assert chat.parsed(out.tobytes().decode()) == [("r\\\nole", t) for t in TRICKY]


PAGE = "page_id long, url string, html string, digest string, keeper int"


def page_rows():
    rows = [(k, f"http://x/{k}", f"<p>{prose(k % 7, 30)}</p>") for k in range(20)]
    return rows + [(30, None, None), (31, "http://a\r\nb", ""), (None, "u", "same"), (None, "u", "same"), (40, "u", "same"), (40, "v", "same"),
                   (None, "w", "only null"), (50, "é", "ü" * 1_000_000), (51, "t", "\r\n\r\nWARC/1.1\r\n")]


@pytest.mark.parametrize("file_bytes", [1 << 28, 2000])
def test_warc_round_trip(spark, file_bytes):
    rows = page_rows()
    frame = spark.createDataFrame([(*r, "d", 1) for r in rows], PAGE).repartition(3)
    manifest = warc.write_archives(frame, fresh(spark, "warc"), file_bytes)
    assert manifest.agg({"n_records": "sum"}).first()[0] == len(rows)
    out = warc.read_archives(manifest, with_payload=True).collect()
    best = {}
    for k, _, h in rows:
        best[h or ""] = max(best.get(h or "", -1), -1 if k is None else k)
    want = []
    for k, _, h in rows:
        body, keeper = (h or "").encode(), best[h or ""]
        first = keeper == (-1 if k is None else k)
        want.append((str(k), len(body), warc.digest(body), "response" if first else "revisit", "None" if first else str(keeper), body if first else None))
    assert all(r.valid for r in out)
    assert sorted(map(repr, want)) == sorted(
        repr((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to), r.payload and bytes(r.payload) if r.payload is not None else None)) for r in out)
    assert warc.read_archives(warc.write_archives(frame.limit(0), fresh(spark, "warc"))).count() == 0


def test_small_payloads_are_responses(spark):
    frame = spark.createDataFrame([(1, "u", "ab", "", 0), (2, "u", "ab", "", 0), (3, "u", "abcd", "", 0), (4, "u", "abcd", "", 0)], PAGE)
    assert {r.page_id: r.revisit for r in warc.with_roles(frame, min_bytes=3).collect()} == {1: False, 2: False, 3: True, 4: False}


def test_damaged_archives_are_noticed(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 7)
    good = warc.page_record(1, "u", b"payload", None, False) + warc.page_record(2, "u", b"", 1, True)
    assert [r.kind for r in warc.records(io.BytesIO(good))] == ["response", "revisit"]
    assert gzip.decompress(good).startswith(b"WARC/1.1\r\n")
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(good[:-5])))
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(good + b"junk")))
    wrong = warc.record("response", [("WARC-Payload-Digest", "sha1:" + warc.digest(b"other"))], b"HTTP/1.1 200 OK\r\n\r\npayload")
    assert warc._parsed(next(warc.records(io.BytesIO(wrong))), False)[6] is False


VECTOR = "vec_id long, embedding array<float>, label int, _node string"


@pytest.mark.parametrize("split", [embeddings.SPLIT, 16])
def test_embedding_links_equal_brute_force(spark, monkeypatch, split):
    monkeypatch.setattr(embeddings, "SPLIT", split)
    r = np.random.default_rng(2)
    rows = []
    for k in range(60):
        centre = r.normal(size=24)
        for c in range(6):
            rows.append((len(rows), (centre + r.normal(size=24) * 0.17 * c / 3).astype(np.float32).tolist(), k % 3))
    rows += [(len(rows) + i, rows[0][1], rows[0][2]) for i in range(40)] + [(500, [2 * x for x in rows[0][1]], rows[0][2])]
    rows += [(600, None, 1), (601, [], 1), (602, [0.0] * 24, 1), (603, [float("nan")] + [1.0] * 23, 1), (604, [None] + [1.0] * 23, 1),
             (605, rows[0][1], None), (606, [float("inf")] * 24, 1), (607, [1.0, 0.0], 1), (608, [2.0, 0.0], 1), (None, rows[7][1], rows[7][2]),
             (609, [1e-30] + [0.0] * 23, 1), (610, [1e30] + [0.0] * 23, 1)]
    rows += [rows[12]]

    def fine(e, label):
        return label is not None and bool(e) and all(x is not None and np.isfinite(x) for x in e) and any(e)

    unit = [np.array(e, float) / np.linalg.norm(np.array(e, float)) if fine(e, x) else None for _, e, x in rows]
    link = lambda i, j: (unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2]
                         and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98)
    group = components(len(rows), link)
    low = {}
    for (k, *_), g in zip(rows, group):
        if k is not None:
            low[g] = min(low.get(g, k), k)
    want = [(str(k), sum(link(i, j) for j in range(len(rows)) if j != i), str(low.get(group[i])), k is not None and k == low[group[i]])
            for i, (k, *_) in enumerate(rows)]
    out = embeddings.linked(spark.createDataFrame([(*x, "n") for x in rows], VECTOR).repartition(4)).collect()
    assert sorted((str(x.vec_id), x.n_links, str(x.component_id), x.kept) for x in out) == sorted(want)


def test_recall_below_one_is_measured(spark):
    r = np.random.default_rng(5)
    base = r.normal(size=(400, 32))
    near = base + r.normal(size=base.shape) * 0.08
    sample = np.concatenate([base, near])
    index = embeddings.fit_index(sample, 1e6, 0.98, recall=0.9)
    u = embeddings.unit(sample)
    own, who, cell = index.visits(u)
    met = set(zip(who.tolist(), cell.tolist()))
    pairs = [(i, j) for i, j in zip(*np.nonzero(np.triu(u @ u.T >= 0.98, 1)))]
    assert pairs and np.mean([(i, own[j]) in met for i, j in pairs]) >= 0.85
    exact = embeddings.fit_index(sample, 1e6, 0.98)
    own, who, cell = exact.visits(u)
    met = set(zip(who.tolist(), cell.tolist()))
    assert all((i, own[j]) in met and (j, own[i]) in met for i, j in pairs)


def test_no_vectors(spark):
    assert embeddings.linked(spark.createDataFrame([], VECTOR)).count() == 0
    out = embeddings.linked(spark.createDataFrame([(1, None, 1, "")], VECTOR)).first()
    assert (out.n_links, out.component_id, out.kept) == (0, 1, True)


def test_pipeline_stages(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    leaks = {r.text for r in spark.read.parquet(f"{sample}/benchmark.parquet").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "simhash_dedup", "decontaminate", "pack"]
    left = docs
    for name, work in corpus_pipeline.STAGES[:-1]:
        before = left.count()
        left = work(spark, left, sample).cache()
        assert left.columns == docs.columns and 0 < left.count() <= before
    rows = left.collect()
    assert not any(leak in (r.text or "") for r in rows for leak in leaks)
    packed = corpus_pipeline.STAGES[-1][1](spark, left, sample).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in rows}


def test_pipeline_of_odd_rows(spark, sample):
    text = prose(4, 80)
    rows = [(1, None), (2, ""), (None, text), (3, text), (3, text), (4, prose(5, 90)), (5, prose(6, 60_000))]
    left = documents(spark, rows)
    columns = left.columns
    for _, work in corpus_pipeline.STAGES[:-1]:
        left = work(spark, left, sample)
        assert left.columns == columns
    assert {r.doc_id for r in left.collect()} >= {3, 4, 5}
    assert corpus_pipeline.STAGES[-1][1](spark, left, sample).count() >= 3
    for _, work in corpus_pipeline.STAGES:
        assert work(spark, documents(spark, []), sample).count() == 0
