"""Best-fit packing, the audit of filters and ranked lexical search, against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chroniq.llm import audit, packing, search
from chroniq.llm.queries import tokenizer_path

# ------------------------------------------------------------------ packing


def best_fit(lengths, most):
    """Room left in each sequence after placing the lengths one by one, longest first, where the least room holds them."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits)[1]] -= n
        else:
            room.append(most - n)
    return room


def laid_out(slots, counts):
    """(sequence, offset, length) of every piece of a histogram."""
    length = np.repeat(np.arange(len(counts)), counts)
    rank = np.concatenate([np.arange(c) for c in counts]) if len(counts) else np.zeros(0, np.int64)
    return [*zip(*(x.tolist() for x in packing.places(slots, length, rank)), length.tolist(), strict=True)]


def assert_gapless(rows, most):
    at = Counter()
    for sequence, offset, length in sorted(rows):
        assert offset == at[sequence]
        at[sequence] += length
    assert all(n <= most for n in at.values())
    return at


@pytest.mark.parametrize("most", [1, 7, 32, 100])
def test_plan_is_best_fit(most):
    rng = random.Random(most)
    for trial in range(60):
        counts = np.zeros(most + 1, np.int64)
        for _ in range(rng.randrange(0, 12)):
            counts[rng.randrange(1, most + 1)] += rng.choice([1, 2, 5, 40])
        slots = packing.plan(counts, most)
        rows = laid_out(slots, counts)
        used = assert_gapless(rows, most)
        want = best_fit([n for n in range(most + 1) for _ in range(counts[n])], most)
        assert len(used) == len(want) == slots["sequences"], trial
        assert sorted(most - n for n in used.values()) == sorted(want)


def test_plan_of_a_huge_histogram():
    rng = np.random.default_rng(3)
    counts = np.append(0, rng.integers(0, 10**9, 2048))
    slots = packing.plan(counts, 2048)
    assert slots["n"].sum() == counts.sum() and len(slots["n"]) < 70_000
    assert slots["sequences"] >= -(-(counts * np.arange(2049)).sum() // 2048)


@pytest.mark.parametrize(("most", "rows"), [(2048, 1_000_000), (40, 1_000_000), (40, 0)])
def test_pack(spark, monkeypatch, documents, no_documents, corpus, most, rows):
    monkeypatch.setattr(packing, "BROADCAST_COUNTS", rows)
    out = packing.pack(documents, tokenizer_path(), most=most)
    t, want = Tokenizer.from_file(tokenizer_path()), {}
    for i, text, *_ in corpus:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        first = (len(ids) - 1) % most + 1
        edges = [0, *range(first, len(ids) + 1, most)]
        want |= {(i, k, a): ids[a:b] for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))}
    got = out.withColumn("crc", F.crc32("ids")).collect()
    assert {(r.doc_id, r.piece, r.start): np.frombuffer(r.ids, "<u4").tolist() for r in got} == want and len(got) == len(want)
    assert all(r.length == len(r.ids) // 4 and r.crc == zlib.crc32(r.ids) for r in got)
    used = assert_gapless([(r.sequence_id, r.offset, r.length) for r in got], most)
    assert len(used) == len(best_fit([len(x) for x in want.values()], most))
    whole = {r.sequence_id: r for r in packing.sequences(out).collect()}
    for r in got:
        assert bytes(whole[r.sequence_id].ids)[4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
    assert {k: len(r.ids) // 4 for k, r in whole.items()} == dict(used)
    assert packing.pack(no_documents, tokenizer_path()).count() == 0


def test_pack_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (2, None), (2, "")] * 30, "doc_id long, text string").repartition(4)
    got = packing.pack(docs, tokenizer_path(), most=5).collect()
    assert Counter(r.doc_id for r in got) == {1: 60, None: 30, 2: 60}
    used = assert_gapless([(r.sequence_id, r.offset, r.length) for r in got], 5)
    assert len(used) == len(best_fit([r.length for r in got], 5))


# ------------------------------------------------------------------ the audit of filters


def plain_audit(docs, labels):
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    good, toxic = ({i for i, *x in labels if x[k] == 1 and i is not None} for k in (0, 1))
    fails = []
    for i, text, source in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = "A" * (len(w) < 50) + "B" * (100 * len(set(w)) < 65 * len(w)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 5 * len(t)) + "D" * bool(re.search(r"[#$%&*|]", t))
        fails.append((source or "", f + "E" * (i is not None and first[t] < i), i in good, i in toxic))
    out = {}
    for part in {p for p, *_ in fails}:
        mine, total = [x for x in fails if x[0] == part], Counter()
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                total[f] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(f in x[1] for x in mine) - len(gone), sum(x[1] == f for x in mine), sum(x[2] for x in gone), sum(x[3] for x in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize(("parts", "few"), [(1000, 10**6), (2, 0)])
def test_filter_audit(spark, monkeypatch, corpus, documents, parts, few):
    monkeypatch.setattr(audit, "PARTS", parts)
    monkeypatch.setattr(audit, "BROADCAST_TEXTS", few)
    monkeypatch.setattr(audit, "BROADCAST_LABELS", few)
    rng = random.Random(4)
    more = [(200 + i, rng.choice([t for _, t, *_ in corpus]), rng.choice(["", None, "s1"])) for i in range(30)]
    more += [(300, "LOUD WORDS HERE", "s1"), (301, "ok #tag", "s1"), (301, "ok #tag", "s2"), (None, "ok #tag", "s2"), (302, "Ünï É", None), (303, "x " * 70, "s2"), (304, " ".join(f"w{i}" for i in range(60)) + "\x0b$", "s2")]
    docs = [(i, t, s) for i, t, _, s in corpus] + more
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 310, 2)] + [(4, 1, 1), (None, 1, 1), (10, None, 1)]
    labels = [(i, q, None if x is None else int(x)) for i, q, x in labels]
    table = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, source string, pattern int, part string").repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = audit.audit_filters(table, marks)
    columns = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = {(r.part, r.filter_order, r.step): tuple(r[c] for c in columns) for r in out.collect()}
    assert got == plain_audit(docs, labels) and out.count() == len(got) == 600 * len({s or "" for *_, s in docs})
    assert audit.audit_filters(table.filter("false"), marks).count() == 0
    assert audit.audit_filters(table, marks.filter("false")).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()[:] == (0, 0)


# ------------------------------------------------------------------ ranked lexical search


def tokens_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, most=10):
    held = [(i, Counter(tokens_of(t))) for i, t in docs]
    n_docs, length = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = defaultdict(list)
    for k, (item, text) in enumerate(items):
        scored = []
        for i, c in held:
            m = 10 + 90 * sum(c.values()) * n_docs // max(length, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(tokens_of(text)) if c[t])
            if s > 0 and i is not None:
                scored.append((-s, i))
        out[k] = [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:most], 1)]
    return sorted((x for v in out.values() for x in v), key=str)


@pytest.mark.parametrize("shard_bytes", [1, 3000, 32 << 20])
def test_search(spark, corpus, documents, no_documents, shard_bytes):
    texts = {i: t for i, t, *_ in corpus}
    items = [(1, " ".join(texts[105].split()[50:90])), (2, texts[92]), (3, None), (4, "... --"), (5, "nothingofthesort"), (6, "An BE, an changed one same"), (7, texts[3] + " same SAME"), (7, "日本 ünï"), (8, "one")]
    table = spark.createDataFrame([(*x, 1, 2) for x in items], "item_id long, text string, doc_id int, score int")
    out = search.ranked(documents, table, shard_bytes=shard_bytes)
    got = sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in out.collect()), key=str)
    assert got == plain_search([(i, t) for i, t, *_ in corpus], items) and len(got) > 30
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert search.ranked(no_documents, table).count() == 0 and search.ranked(documents, table.filter("false")).count() == 0
    assert search.ranked(documents, table.filter("item_id = 4")).count() == 0


def test_search_ties_repeats_and_null_ids(spark):
    docs = [(i % 40, "red fox") for i in range(80)] + [(None, "red fox jumps"), (50, "red"), (51, ""), (52, None)] + [(100 + i, f"word{i} red") for i in range(50)]
    items = [(1, "fox red"), (2, "jumps"), (3, "word7")]
    table, wanted = spark.createDataFrame(docs, "doc_id long, text string").repartition(6), spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in search.ranked(table, wanted, shard_bytes=50).collect()), key=str)
    assert got == plain_search(docs, items) and {x[2] for x in got if x[0] == 1} == {0, 1, 2, 3, 4}


def test_search_in_item_blocks(spark, monkeypatch, corpus, documents):
    from chroniq.llm import decontaminate

    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)
    items = [(i, t) for i, t, *_ in corpus[:20]]
    got = sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in search.ranked(documents, spark.createDataFrame(items, "item_id long, text string")).collect()), key=str)
    assert got == plain_search([(i, t) for i, t, *_ in corpus], items)


def test_lists_are_only_probed_while_a_document_can_qualify():
    """Random shards against dense sums; and a common term's list is not scored once rare ones fill the result."""
    rng = np.random.default_rng(8)
    for _ in range(200):
        docs, vocabulary = int(rng.integers(1, 60)), int(rng.integers(1, 9))
        dense = rng.integers(1, 40, (vocabulary, docs)) * (rng.random((vocabulary, docs)) < rng.random((vocabulary, 1)))
        term, doc = np.nonzero(dense)
        ids, best = rng.permutation(docs * 2)[:docs], search.Best(1, 4)
        half = docs // 2
        for a, b in ((0, half), (half, docs)):  # the second shard begins with the first one's result
            own = (doc >= a) & (doc < b)
            search.Shard(ids[a:b], term[own], doc[own] - a, dense[term[own], doc[own]], vocabulary).search(0, np.arange(vocabulary), best)
        want = sorted((-s, i) for s, i in zip(dense.sum(0).tolist(), ids.tolist(), strict=True) if s)[:4]
        assert [(-s, i) for s, i in zip(best.score[0].tolist(), best.doc[0].tolist(), strict=True)] == want
    adds = np.concatenate([np.full(20, 1000), np.full(5000, 3)])
    shard = search.Shard(np.arange(5000), np.repeat([0, 1], [20, 5000]), np.concatenate([np.arange(0, 5000, 250), np.arange(5000)]), adds, 2)
    best = search.Best(1, 10)
    shard.search(0, np.array([0, 1]), best)
    assert shard.scored == 20 and shard.probed == 20 and best.score[0].tolist() == [1003] * 10 and best.doc[0].tolist() == list(range(0, 2500, 250))
