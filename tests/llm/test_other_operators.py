"""Vector search, WARC and the pipeline."""

import base64
import hashlib
import math
import random
import time
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from chroniq.llm import mixture, queries, topk, warc
from chroniq.llm.queries import tokenizer_path
from pyspark.sql import functions as F

# ------------------------------------------------------------------ 4


def plain_top(rows, k=5):
    good = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("small_blocks", [False, True])
def test_top_k(spark, monkeypatch, small_blocks):
    rng = np.random.default_rng(0)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.2, 8)]) for i in range(400)]
    for i in range(60, 100):
        rows[i] = (i, rows[50][1])  # ties
    rows[3], rows[4], rows[5], rows[6], rows[7], rows[150] = (3, None), (4, [None, 1.0]), (5, [math.nan] * 8), (6, [math.inf] * 8), (7, []), (150, [0.0] * 8)
    rows += [(1000, [1.0, 2.0]), (None, [1.0])]
    if small_blocks:
        monkeypatch.setattr(topk, "CANDIDATES", 10)
        monkeypatch.setattr(topk, "QUERIES", 3)
        monkeypatch.setattr(topk, "SCORES", 50)
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score double")
    assert sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0).collect())) == plain_top(rows)
    assert topk.top_k(df.filter("false"), F.col("vec_id") % 50 == 0).count() == 0
    few = df.filter("vec_id in (0, 50)")
    assert topk.top_k(few, F.col("vec_id") % 50 == 0).count() == 2


def test_top_k_of_large_components(spark):
    """Finite components of 2**23 and more take part; sums beyond a long on the way do no harm, such a score fails."""
    rows = [(i, [float(i), 1.0, 1.0]) for i in range(1, 12)] + [(50, [1.0, -3.0, 0.5]), (51, [9.0e6, 5.0, 2.0]), (100, [1.0, 2.0, 3.0])]
    rows += [(150, [2.0**23, 2.0**23, 1.0]), (53, [2.0**30, -(2.0**30), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0).collect())) == plain_top(rows)
    for v in ([2.0**60], [2.0**30, 2.0**30]):
        bad = spark.createDataFrame([(50, v), (51, v)], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="too large"):
            topk.top_k(bad, F.col("vec_id") % 50 == 0).collect()


# ------------------------------------------------------------------ 7


def plain_warc(rows):
    top = {}
    for i, _, h in rows:
        if i is not None:
            top[h or ""] = max(i, top.get(h or "", i))
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        revisit = (h or "") in top and i != top[h or ""] and sum((x[2] or "") == (h or "") for x in rows) > 1
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", top[h or ""] if revisit else None))
    return sorted(out, key=repr)


FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
PAGES = [
    (1, "http://a/", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "x\r\nWARC-Type: y", None), (4, "http://WARC/1.1", ""), (5, "u", FAKE * 3), (6, "u", "WARC/1." * 50), (7, "u", "a" * 300_000 + FAKE + "b" * 200_000),
    (7, "u", "same id"), (8, "u", "\r\n\r\n"), (9, "u", "WARC/1.1\r\nContent-Length: 99999\r\n\r\n"), (None, "u", "<p>é</p>"), (10, "u", "<p>é</p>"), (11, "u", FAKE[:-4]), (12, "u", FAKE * 3),
]


@pytest.mark.parametrize("split", ["64k", "8000", "128m", "20000, not broadcast"])
def test_warc(spark, split, monkeypatch):
    if "not" in split:
        monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
        split = split.split(",")[0]
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = spark.createDataFrame([(*r, 1, "d") for r in PAGES], "page_id long, url string, html string, bytes int, digest string").repartition(2)
        assert sorted(map(tuple, warc.warc_round_trip(df).collect()), key=repr) == plain_warc(PAGES)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


def test_warc_edges(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.warc_round_trip(none).count() == 0
    (tmp_path / "w").mkdir()
    good = "WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{}>\r\nContent-Type: text/html\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "w/a.warc").write_bytes((good.format(1) + good.format(2) + "junk" + good.format(3)).encode())
    (tmp_path / "w/b.warc").write_bytes(("junk" + good.format(4)).encode())
    (tmp_path / "w/c.warc").write_bytes(b"")
    assert sorted((r.page_id, r.kind, r.bytes) for r in warc.read_warc(spark, str(tmp_path / "w")).collect()) == [(1, "resource", 3), (2, "resource", 3)]


def test_false_headers_hold_no_payload():
    """A payload of 60,000 headers that each claim a long block: the first pass holds offsets, the second a digest."""
    false = b"1\r\nWARC-Record-ID: <urn:page:5>\r\nContent-Length: 3000000\r\n\r\n" + b"x" * 40
    payload = (b"WARC/1." + false) * 60_000
    head = b"1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: %d\r\n\r\n" % len(payload)
    pieces = [b"", head, *[false] * 59_999, false + b"\r\n\r\n"]

    def batches(*more):
        for i in range(0, len(pieces), 5_000):
            part = pieces[i : i + 5_000]
            n = len(part)
            yield pa.RecordBatch.from_arrays([pa.array(["f"] * n), pa.array([0] * n), *[pa.array([x] * n) for x in more], pa.array(part, pa.binary())], names=["file", "split", *["enter"] * len(more), "value"])

    tracemalloc.start()
    began = time.process_time()
    found = pa.Table.from_batches(warc.candidates(batches()))
    assert found["covered"].to_pylist()[-1] == sum(map(len, pieces)) + 7 * len(pieces)
    true = pa.Table.from_batches(warc.records(batches(7))).to_pylist()
    assert [(r["page_id"], r["whole"], r["bytes"], r["digest"]) for r in true] == [(1, True, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())]
    assert tracemalloc.get_traced_memory()[1] < 40e6 and time.process_time() - began < 20
    tracemalloc.stop()


# ------------------------------------------------------------------ pipeline


def test_pipeline(spark, documents, corpus, tmp_path):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES][1] == "simhash near-dedup" and corpus_pipeline.ORACLE_SQL is None
    d = documents.select("doc_id", "text", "lang", "source", "n_chars")
    d.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, " ".join(corpus[105][1].split()[50:90]))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    ids = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / f"out{k}"))
        docs = spark.read.parquet(str(tmp_path / f"out{k}"))
        ids.append(sorted(r.doc_id for r in docs.select("doc_id").collect()))
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    everything = sorted(r[0] for r in corpus)
    assert ids[0] == everything
    assert ids[1] == [i for i in everything if not (60 <= i < 75 or 75 < i < 90 or i in (101, 102))]
    assert ids[2] == [i for i in ids[1] if i != 105]
    assert set(ids[3]) <= set(ids[2]) and ids[4] == ids[3]
    total = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, total.collect())) == sorted(map(tuple, docs.collect()))


def edited(rng, words, kind):
    """A copy of at least 0.8 Jaccard similarity of its five-word shingles: cut off, appended, inserted or with words replaced."""
    n = len(words)
    extra = [f"new{rng.randrange(10**6)}" for _ in range(n // 10)]
    if kind == "cut":
        return words[: n - n // 10]
    if kind == "appended":
        return words + extra
    if kind == "inserted":
        return words[: n // 2] + extra + words[n // 2 :]
    out = list(words)
    for i in (n // 3, 2 * n // 3):
        out[i] = "changed"
    return out


def test_every_stage_takes_rows_away(spark, tmp_path):
    """Each stage against brute force on its own input, on a corpus in which each one has something to remove."""
    import corpus_pipeline

    rng = random.Random(21)
    word = lambda: "".join(rng.choice(["an", "be", "co", "di", "el", "fo", "gu", "ha"]) for _ in range(rng.randrange(1, 4)))
    prose = lambda n: [word() for _ in range(n)]
    texts, toxic = {}, set()
    for i in range(400):
        texts[i] = prose(rng.randrange(40, 160))
        if i % 4 == 0:
            toxic.add(i)
            for _ in range(8):
                texts[i][rng.randrange(len(texts[i]))] = rng.choice(["vilescum", "grubfoul", "rotsnarl"])
    clean = [i for i in range(400) if i % 4]
    for k, kind in enumerate(["cut", "appended", "inserted", "replaced"] * 10):
        texts[1000 + k] = edited(rng, texts[clean[k]], kind)
    items = [(k, " ".join(prose(25))) for k in range(5)]
    for k in range(10):
        texts[2000 + k] = prose(300) + items[k % 5][1].split() + prose(300)
    rows = [(i, " ".join(w), "en", f"s{i % 3}" if i % 5 else "s0", 1) for i, w in texts.items()] + [(3000, None, None, None, 0), (3001, "", "en", "s1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(400)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"out{k}"))
        docs = spark.read.parquet(str(tmp_path / f"out{k}"))
        kept.append(sorted(r.doc_id for r in docs.select("doc_id").collect()))
    everything = {r[0]: r[1] for r in rows}
    assert kept[0] == sorted(set(everything) - toxic)
    # near copies: components of exact similarity
    sets = {i: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set() for i in kept[0] for w in [(everything[i] or "").lower().split()]}
    label = {i: i for i in kept[0]}
    for a in kept[0]:
        for b in kept[0]:
            if a < b and ((not sets[a] and not sets[b]) or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])):
                x, y = label[a], label[b]
                label = {i: min(x, y) if m in (x, y) else m for i, m in label.items()}
    assert kept[1] == sorted(i for i, m in label.items() if i == m) and len(kept[0]) - len(kept[1]) >= 35
    assert kept[2] == [i for i in kept[1] if not 2000 <= i < 2010] and len(kept[2]) < len(kept[1])
    copies = {r.doc_id: r.copies for r in mixture.mix_table(spark.read.parquet(str(tmp_path / "out2"))).collect()}
    assert kept[3] == sorted(i for i, n in copies.items() for _ in range(n)) and set(kept[2]) - set(kept[3])
    t, at = Tokenizer.from_file(tokenizer_path()), 0
    for r, i in zip(docs.orderBy("start").collect(), kept[3], strict=True):
        ids = t.encode(everything[i] or "", add_special_tokens=False).ids + [2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_near_copies_go_by_row(spark, tmp_path):
    """A doc_id that repeats with another text loses only the text that is a copy; extra columns stay."""
    import corpus_pipeline

    rng = random.Random(5)
    a, b, c = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(3))
    near = a.replace(a.split()[30], "other")
    rows = [(1, a, 0), (5, a, 1), (5, b, 2), (9, c, 3), (None, a, 4), (None, "alone here", 5), (1, near, 6), (9, c, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int")
    out = corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path))
    got = {(r.doc_id, r.text, r.key) for r in out.collect()}
    stays = {r for r in got if r[0] == 1}
    assert len(stays) == 1 and stays < {rows[0], rows[6]}
    assert got - stays == {rows[2], rows[3], rows[5], rows[7]} and out.columns == docs.columns
    assert corpus_pipeline.drop_near_copies(spark, docs.filter("false"), str(tmp_path)).count() == 0


def test_results_outlive_other_calls(spark, documents, tmp_path):
    """No stage deletes what a lazy result of another call reads."""
    import corpus_pipeline

    spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = documents.select("doc_id", "text", "lang", "source", "n_chars")
    a = corpus_pipeline.write_tokens(spark, docs, str(tmp_path))
    b = corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path))
    c = corpus_pipeline.mix_sources(spark, docs, str(tmp_path))
    corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).count()
    corpus_pipeline.drop_near_copies(spark, docs.limit(5), str(tmp_path)).count()
    assert a.count() == docs.count() and 0 < b.count() < docs.count() and c.count() > 0


def test_pipeline_of_empty_tables(spark, tmp_path):
    import corpus_pipeline

    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


# ------------------------------------------------------------------ settings of production


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n in queries.ORACLES])
def test_compiled_and_adaptive(spark, name):
    """The queries against their SQL with code generation and adaptive plans, as a cluster runs them."""
    settings = {"spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK", "spark.sql.adaptive.enabled": "true", "spark.sql.shuffle.partitions": "7"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        d = "/root/testdata/sf0.001"
        con = duckdb.connect()
        for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
        want = con.execute(queries.ORACLES[name])
        names = [x[0] for x in want.description]
        near = lambda rows: sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows), key=repr)
        assert near(map(tuple, queries.QUERIES[name](spark, d).select(*names).collect())) == near(want.fetchall())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLES and n != "pipeline"])
def test_compiled_and_adaptive_without_sql(spark, name):
    """The queries that have no SQL give the same with code generation and adaptive plans as without; places may differ."""
    d, rows = "/root/testdata/sf0.001", []
    settings = {"spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK", "spark.sql.adaptive.enabled": "true", "spark.sql.shuffle.partitions": "7"}
    old = {k: spark.conf.get(k) for k in settings}
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] if name == "op11_packing" else None
    for change in ({}, settings):
        for k, v in change.items():
            spark.conf.set(k, v)
        out = queries.QUERIES[name](spark, d)
        rows.append(sorted(map(tuple, (out.select(*columns) if columns else out).collect()), key=repr))
    for k, v in old.items():
        spark.conf.set(k, v)
    near = lambda r: [tuple(round(x, 5) if isinstance(x, float) else x for x in y) for y in r]
    assert rows[0] and near(rows[0]) == near(rows[1])
