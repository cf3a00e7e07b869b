"""Operators over texts against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from chroniq.llm import common, decontaminate, langid, mixture, pu, quality, simhash, substring, tokens, toxicity
from chroniq.llm.common import U, column_bytes
from chroniq.llm.components import components, spanning_stars
from chroniq.llm.queries import tokenizer_path


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ------------------------------------------------------------------ 1


def shingles(text, k=5):
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def item_shingles(text):
    """Those of an item, and how many tokens they have."""
    k = 5 if shingles(text) else len(shingles(text, 1) and re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower()))
    return (shingles(text, k), k) if k else (set(), 5)


def test_contaminated(spark, corpus, documents, no_documents, monkeypatch):
    texts = {i: t for i, t, *_ in corpus}
    items = [(0, " ".join(texts[105].split()[4000:4040])), (1, texts[90].split("\n")[1].upper()), (2, "one"), (3, None), (4, " ,;"), (5, "never seen words in any of the texts here"), (6, texts[7]), (6, texts[7]), (8, " ".join(texts[105].split()[70:73])), (9, "same, same"), (7, " ".join(texts[105].split()[100:130] + ["zz"] * 4))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for d, t, *_ in corpus:
        for m, x in items:
            q, k = item_shingles(x)
            held = q & shingles(t, k)
            if q and len(held) >= math.ceil(0.8 * len(q) - 1e-9):
                want.append((d, m, len(q), len(held)))
    get = lambda: sorted(tuple(r)[:4] for r in decontaminate.contaminated(documents, bench).collect())
    assert get() == sorted(want) and len(want) > 12
    clean = decontaminate.clean_documents(documents, bench)
    assert clean.schema == documents.schema
    assert sorted(r.doc_id for r in clean.select("doc_id").collect()) == sorted(set(texts) - {w[0] for w in want})
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 200)  # more blocks, the same pairs
    assert get() == sorted(want)
    assert decontaminate.contaminated(no_documents, bench).count() == 0
    assert decontaminate.contaminated(documents, bench.filter("false")).count() == 0
    assert decontaminate.clean_documents(documents, bench.filter("false")).count() == len(corpus)


def test_sketches_decide_what_is_verified():
    """Candidates come from the partitions' sketches alone, whose sizes are the least that miss nothing."""
    rng = random.Random(4)
    items = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(n)).encode()) for i, n in enumerate([9, 14, 15, 24, 30, 80, 200, 3])]
    index = decontaminate.Index(items, 5, 0.8)
    assert [p.keep for p in index.partitions] == [1, 2, 3, 6, 16, 40] and len(index.partitions) == 6 and index.short == (3,)
    for i, (_, text) in enumerate(items):
        hashes, texts = index.held[i]
        part = next(p for p in index.partitions if i in p.items)
        sketch = set(part.values[part.items == i].tolist())
        assert sketch == set(hashes[: part.keep].tolist())
        # a document of exactly the needed shingles, those with the largest hashes, still meets the sketch
        last = b" . ".join(texts[-index.need[i] :])
        data, offsets = column_bytes(pa.array([last + b" zz" * 6, b"nothing of it", text], pa.binary()))
        assert {(d, m) for d, m, _ in index.search(data, offsets)} >= {(0, i), (2, i)} and (1, i) not in {(d, m) for d, m, _ in index.search(data, offsets)}
        before, part.values = part.values, part.values ^ U(1 << 40)  # without its sketch an item is never found
        assert not [1 for _, m, _ in index.search(data, offsets) if m == i]
        part.values = before


# ------------------------------------------------------------------ 2


def test_mix(spark, corpus, documents, no_documents):
    rows = mixture.mix_table(documents).collect()
    size = {i: len(words_of(t)) for i, t, *_ in corpus}
    source = {i: s for i, _, _, s in corpus}
    assert {r.doc_id: r.size for r in rows} == size and len(rows) == len(corpus)
    totals = {}
    for i, s in source.items():
        totals[s] = totals.get(s, 0) + size[i]
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    weight, cap, target = {s: k % 3 + 1 for k, s in enumerate(order)}, {s: 3 * totals[s] for s in order}, dict.fromkeys(order, 0.0)
    free, left = set(order), sum(totals.values())
    while free:  # share again and again
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * share > cap[s]}
        for s in over or free:
            target[s] = cap[s] if over else weight[s] * share
            left -= target[s]
        free -= over or free
    u = {i: (int(hashlib.md5(str(i).encode()).hexdigest()[:13], 16) + 0.5) / 2**52 for i in size}
    for s in order:  # Pareto order sampling of the extra copies, written out
        rest = target[s] - math.floor(target[s] / max(totals[s], 1)) * totals[s]
        own = [i for i in size if source[i] == s and size[i] > 0]
        odds, certain = {}, set()
        while own and rest > 0:
            rate = (rest - sum(size[i] for i in certain)) / sum(size[i] * size[i].bit_length() for i in own if i not in certain)
            over = {i for i in own if i not in certain and rate * size[i].bit_length() > 1}
            if not over:
                odds = {i: (0.0 if i in certain else (1 - rate * size[i].bit_length()) / (rate * size[i].bit_length())) * u[i] / (1 - u[i]) for i in own}
                break
            certain |= over
        taken, gap = set(), rest
        for i in sorted(odds, key=lambda i: (odds[i], i)):
            if size[i] > gap:
                break
            taken.add(i)
            gap -= size[i]
        fill = min((abs(gap - size[i]) - gap, i) for i in odds if i not in taken) if len(taken) < len(odds) else (0, None)
        taken |= {fill[1]} if fill[0] < 0 else set()
        assert {r.doc_id for r in rows if source[r.doc_id] == s and r.copies > math.floor(r.target / max(r.source_size, 1))} == taken
    for r in rows:
        assert r.source_size == totals[source[r.doc_id]] and r.target == pytest.approx(target[source[r.doc_id]])
        assert r.taken == r.copies * r.size <= 3 * r.size
        assert r.copies - math.floor(r.target / max(r.source_size, 1)) in (0, 1)
    for s in order:
        taken = sum(r.taken for r in rows if source[r.doc_id] == s)
        largest = max(size[i] for i in source if source[i] == s)
        assert abs(taken - target[s]) <= largest / 2 + 1
    assert sorted(rows) == sorted(mixture.mix_table(documents.repartition(3)).collect())
    mixed = mixture.mix_documents(documents)
    assert mixed.columns == documents.columns
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {r.doc_id: r.copies for r in rows if r.copies}
    assert mixture.mix_table(no_documents).count() == 0 and mixture.mix_documents(no_documents).count() == 0
    assert {(r.taken, r.target) for r in mixture.mix_table(documents.withColumn("text", F.lit(" "))).collect()} == {(0, 0.0)}
    twice = mixture.mix_table(documents.union(documents)).groupBy("doc_id").agg(F.count_distinct("copies").alias("n")).filter("n > 1")
    assert twice.count() == 0


# ------------------------------------------------------------------ 3


def test_substrings(spark, corpus, documents, no_documents, monkeypatch):
    def brute(rows, window=20):
        seen, out = set(), []
        for i, t, *_ in sorted(rows, key=lambda r: r[0]):
            w, gone = words_of(t), set()
            for a in range(len(w) - window + 1):
                key = tuple(w[a : a + window])
                if key in seen:
                    gone.update(range(a, a + window))
                seen.add(key)
            kept = " ".join(x for k, x in enumerate(w) if k not in gone)
            out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
        return out

    want = brute(corpus)
    get = lambda d: sorted(tuple(r)[:4] for r in substring.dedup_substrings(d).collect())
    assert get(documents) == want and sum(w[2] > 0 for w in want) > 25
    monkeypatch.setattr(substring, "PIECE_BYTES_HERE", 3000)  # what repeats is found across pieces
    monkeypatch.setattr(substring, "HASH_BYTES", 1000)
    assert get(documents) == want
    assert get(no_documents) == []
    again = substring.dedup_substrings(documents.union(documents)).drop("kept_text")
    assert sorted(map(tuple, again.distinct().collect())) == want and again.count() == 2 * len(corpus)
    monkeypatch.setattr(substring, "HOT_WINDOWS", 1)  # every seed that the sample sees is dealt by window
    monkeypatch.setattr(substring, "SAMPLED", 2)
    assert get(documents) == want
    ids = substring.dedup_substrings(documents.withColumn("doc_id", F.lit(None).cast("long")))
    assert ids.filter("n_removed > 0").count() == 0 and ids.count() == len(corpus)
    assert substring.SEED < 20


def test_greedy_factors():
    """Each factor is the longest earlier match at the cursor; windows across boundaries are found; against a naive parse."""
    rng = random.Random(6)
    for window, letters in ((3, 2), (2, 3), (4, 1), (20, 2)):
        strings = [[rng.randrange(letters) for _ in range(rng.randrange(0, 40))] for _ in range(12)]
        strings += [strings[3], strings[0][5:30] + strings[1][:20]]
        cells = [(d, p, tuple(s[p : p + window])) for d, s in enumerate(strings) for p in range(len(s) - window + 1)]
        kind = {k: n for n, k in enumerate(sorted({k for *_, k in cells}))}
        of, pos, ident = np.array([d for d, *_ in cells], np.int64), np.array([p for _, p, _ in cells], np.int64), np.array([kind[k] for *_, k in cells], np.int64)
        parsed = substring.parse(substring.Index(of, pos, np.arange(len(cells)), ident), window)
        got = list(zip(*(x.tolist() for x in parsed[:3]), strict=True))
        mark = np.zeros(len(cells), bool)
        mark[substring.spread(*substring.duplicates(parsed))] = True
        want, dup, seen = [], [], {}
        first = {}
        for i, (_, _, k) in enumerate(cells):
            dup.append(k in first)
            first.setdefault(k, i)
        place = {(d, p): i for i, (d, p, _) in enumerate(cells)}
        for d, s in enumerate(strings):
            p = 0
            while p <= len(s) - window:
                best = 0
                for e, t in enumerate(strings[: d + 1]):
                    for q in range(len(t) - window + 1):
                        if (e, q) < (d, p):
                            m = 0
                            while p + m < len(s) and q + m < len(t) and s[p + m] == t[q + m]:
                                m += 1
                            best = max(best, m)
                if best >= window:
                    want.append((place[d, p], best - window + 1))
                p += best if best >= window else 1
        assert [(i, m) for i, m, _ in got] == want and mark.tolist() == dup
        assert all(j < i and [c[2] for c in cells[i : i + m]] == [c[2] for c in cells[j : j + m]] for i, m, j in got)


@pytest.mark.parametrize("piece", [6 << 20, 1])
def test_spans_come_from_the_parse(spark, monkeypatch, piece):
    """Without the factors less is removed: nothing else marks the windows in them, in pieces or blocks."""
    rng = random.Random(14)
    w = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    # the third text's first factor is the first one; the second has what lies across the end of that factor
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate([w[:100], w[85:115], w[:115] + w[300:340], w[290:340]])], "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(substring, "PIECE_BYTES_HERE", piece)
    monkeypatch.setattr(substring, "HASH_BYTES", min(piece, substring.HASH_BYTES))
    whole = {r.doc_id: r.n_removed for r in substring.dedup_substrings(docs).collect()}
    assert whole == {0: 0, 1: 0, 2: 115, 3: 40}

    monkeypatch.setattr(substring, "duplicates", lambda parsed: (parsed[3], np.ones(len(parsed[3]), np.int64)))
    part = {r.doc_id: r.n_removed for r in substring.dedup_substrings(docs).collect()}
    assert sum(part.values()) < sum(whole.values()) and all(part[i] <= n for i, n in whole.items())


def test_nearest_smaller():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 7, 8, 9, 40, 64, 100):
        v = rng.integers(0, 12, n)
        want = [max((j for j in range(i) if v[j] < v[i]), default=-1) for i in range(n)]
        assert substring.nearest_smaller(v).tolist() == want


def test_a_phrase_of_all_documents_fills_no_block(spark, monkeypatch):
    """A phrase that every document holds makes no duplicate window, and its windows are spread over the blocks."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    phrase = " ".join(word() for _ in range(12))
    d = spark.createDataFrame([(i, " ".join([word() for _ in range(20)] + [phrase] + [word() for _ in range(20)])) for i in range(1_500)], "doc_id long, text string")
    sizes = lambda: sorted(r.n for r in substring.dealt(d.select("doc_id", F.col("text").cast("binary").alias("text")), 20).groupBy("block").agg(F.sum(F.octet_length("low") / 4).alias("n")).collect())
    before = sizes()
    monkeypatch.setattr(substring, "HOT_WINDOWS", 1_000)
    after = sizes()
    assert sum(before) == sum(after) == 1_500 * 33 and before[-1] > 5 * before[-3] and after[-1] < 3 * sum(after) / 64
    assert substring.dedup_substrings(d).filter("n_removed > 0").count() == 0


# ------------------------------------------------------------------ 6


def test_tokens(spark, corpus, documents, no_documents, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    odd = [(200, "a  b"), (201, " a"), (202, "x<|endoftext|>y"), (203, "it's 5.a, b!? c'"), (204, "a\t b\r\nc\n\nd "), (205, "　a\xa0b c.\n\x1cd"), (206, "日本 語. é,b ***x*** y%%%")]
    more = documents.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    want, at = [], 0
    for i, x in sorted([(r[0], r[1]) for r in corpus] + odd):
        ids = t.encode(x or "", add_special_tokens=False).ids + [2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, tokens.token_output(more, tokenizer_path()).collect())) == want
    path = str(tmp_path / "tokens")
    tokens.write_tokens(more, path, tokenizer_path())
    (one,) = tokens.read_tokens(spark, path, F.col("doc_id") == 203).collect()
    assert t.decode(one.ids[:-1]) == odd[3][1] and one.ids[-1] == 2
    assert tokens.token_output(no_documents, tokenizer_path()).count() == 0
    both = tokens.token_output(more.union(more), tokenizer_path()).orderBy("start").collect()
    assert [r.start for r in both] == np.concatenate([[0], np.cumsum([r.n_tokens for r in both])[:-1]]).tolist() and [r.doc_id for r in both] == sorted(r.doc_id for r in both)
    assert tokens.token_output(documents.withColumn("doc_id", F.lit(None).cast("long")), tokenizer_path()).count() == len(corpus)


def test_words_are_the_tokenizers(corpus):
    e = tokens.Encoder(tokenizer_path())
    for text in [t for _, t, *_ in corpus if t] + ["a b.\nc d", "B!! C?", "we're 'x' (y) z's"]:
        n, ids = encoded(e, [text])
        assert ids.tolist() == e.whole(text).tolist() + [2] and n.tolist() == [len(ids)]


def encoded(e, texts):
    return e.encode(*column_bytes(pa.array([x if isinstance(x, bytes) else x.encode() for x in texts], pa.binary())), 2)


def test_spans_are_forgotten_and_told_apart(monkeypatch):
    """A small memory, spans whose hashes are all alike, long spans, no texts, empty texts, texts that are no UTF-8."""
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abcé日1.'") for _ in range(rng.randrange(1, 24))) for _ in range(rng.randrange(0, 60))) for _ in range(60)]
    texts += ["", "a", "a\nb", "a b", b"a \xff b", "　a b", "a\u2003b c", "“q” c", "a <|endoftext|> b", "x" * 500 + " y", " a", "a ", "a\tb"]
    plain = lambda e: [e.whole(x.decode("utf-8", "replace") if isinstance(x, bytes) else x).tolist() + [2] for x in texts]
    for alike in (False, True):
        monkeypatch.setattr(tokens, "MEMORY", 64)
        if alike:
            monkeypatch.setattr(tokens, "mix", lambda x: x & U(3))
        e = tokens.Encoder(tokenizer_path())
        want = plain(e)
        for k in (1, 7, len(texts)):
            got = []
            for i in range(0, len(texts), k):
                n, ids = encoded(e, texts[i : i + k])
                got += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
                assert e.known.count < 64 + 4_000
            assert got == want
        assert encoded(e, [])[1].tolist() == []


# ------------------------------------------------------------------ 10


def plain_fingerprint(text, k=3):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(keys, near):
    label = list(range(len(keys)))
    for i in range(len(keys)):
        for j in range(i):
            if near(keys[i], keys[j]):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return label


def test_simhash(spark, corpus, documents, no_documents):
    rows = {r.doc_id: r for r in simhash.simhash_components(documents).collect()}
    ids, fps = [r[0] for r in corpus], [plain_fingerprint(r[1]) for r in corpus]
    assert [rows[i].fp % (1 << 64) for i in ids] == fps
    label = plain_components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    assert [rows[i].component_id for i in ids] == [min(ids[j] for j in range(len(ids)) if label[j] == x) for x in label]
    assert len(set(label)) < len(set(fps))
    assert simhash.simhash_components(no_documents).count() == 0
    assert simhash.simhash_components(documents.union(documents)).count() == 2 * len(corpus)
    assert simhash.simhash_components(documents.withColumn("doc_id", F.lit(None).cast("long"))).count() == len(corpus)


@pytest.mark.parametrize("hot", [None, (2, 6), (4, 3), (1 << 11, 5)])
@pytest.mark.parametrize(("distance", "blocks"), [(3, 2), (7, 4)])
def test_links_of_fingerprints(spark, monkeypatch, distance, blocks, hot):
    """Chains of fingerprints at and just over the distance: no link is lost, none is made up, nor where anchors are large or hot."""
    if hot:
        monkeypatch.setattr(simhash, "LARGE_MEMBERS", hot[0])
        monkeypatch.setattr(simhash, "HOT_MEMBERS", hot[1])
        monkeypatch.setattr(simhash, "SAMPLED", 1)
    rng = np.random.default_rng(distance)
    fps = set()
    for _ in range(25):
        x = int(rng.integers(0, 1 << 63)) * 2 + 1
        for _ in range(12):
            fps.add(x)
            for b in rng.choice(64, int(rng.choice([1, distance, distance + 1])), replace=False):
                x ^= 1 << int(b)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) * 2 for x in fps], "key long, fp long")
    got = {r.id % (1 << 64): r.label for r in components(simhash.linked(df, distance, blocks, None)).collect()}
    label = plain_components(fps, lambda a, b: (a ^ b).bit_count() <= distance)
    groups = {}
    for x, k in zip(fps, label, strict=True):
        groups.setdefault(k, set()).add(x)
    for g in groups.values():
        assert len({got.get(x, x) for x in g}) == 1 and all((x in got) == (len(g) > 1) for x in g)
    assert len({got.get(min(g), min(g)) for g in groups.values()}) == len(groups)


def test_anchor_codes():
    for width, reach in ((32, 1), (16, 1), (23, 2)):
        code, rng = simhash.AnchorCode(width, reach), np.random.default_rng(1)
        x = rng.integers(0, 1 << width, 300, dtype=np.uint64)
        home = code.home(x)
        assert (np.bitwise_count(x ^ home) <= code.radius).all() and (code.home(home) == home).all()
        row, anchor, is_home = code.members(x)
        assert (np.bitwise_count(x[row] ^ anchor) <= code.radius + reach).all() and is_home.sum() == len(x)
        held = set(zip(row.tolist(), anchor.tolist(), strict=True))
        for f in code.flips:
            assert all((i, int(h)) in held for i, h in enumerate(code.home(x ^ f)))


def test_hot_groups_are_bounded(spark, monkeypatch):
    """Where an anchor holds most texts, no group holds many more of it than the bound, and any two texts of it share a group."""
    monkeypatch.setattr(simhash, "HOT_MEMBERS", 64)
    monkeypatch.setattr(simhash, "SAMPLED", 1)
    rng = np.random.default_rng(9)
    upper = np.unique(rng.integers(0, 1 << 31, 900)) << 32  # the lower blocks are all the same
    fps = spark.createDataFrame([(int(x), int(x)) for x in upper], "key long, fp long")
    name, parts = simhash.hot_names(fps, 3, 2)
    assert len(name) and (np.diff(name.astype(object)) > 0).all() and (parts >= 2 * 900 // 64 - 1).any()
    met, size = set(), {}
    top = name[parts.argmax()]
    for entry, bucket in simhash.dealt(np.full(len(upper), top), upper, name, parts, 96):
        for e, b in zip(entry.tolist(), bucket.tolist(), strict=True):
            size.setdefault(b, []).append(e)
    for group in size.values():
        met |= {(min(x, y), max(x, y)) for x in group for y in group if x != y}
    assert len(met) == len(upper) * (len(upper) - 1) // 2 and max(map(len, size.values())) < 2 * 64
    cold = [b for _, b in simhash.dealt(np.full(5, U(77)), upper[:5], name, parts, 96)]
    assert len(cold) == 1 and len(set(cold[0].tolist())) == 1 and cold[0][0] < 96


@pytest.mark.parametrize("hot", [None, (2, 4)])
def test_sketched_components(spark, monkeypatch, documents, corpus, hot):
    """As the pipeline uses it: near copies of 0.9 and more are found, texts that share a passage are not."""
    import corpus_pipeline

    if hot:
        monkeypatch.setattr(simhash, "LARGE_MEMBERS", hot[0])
        monkeypatch.setattr(simhash, "HOT_MEMBERS", hot[1])
        monkeypatch.setattr(simhash, "SAMPLED", 1)

    got = {r.doc_id: r.component_id for r in simhash.simhash_components(documents, **corpus_pipeline.NEAR).collect()}
    assert {got[i] for i in range(75, 90)} == {75}
    assert all(got[i] == i % 5 for i in range(60, 75)) and all(got[i] == i for i in range(90, 100))
    assert got[100] == got[101] == got[102] == 100


def edited_pairs():
    """(text, edited copy, Jaccard similarity of their five-word shingles) by every kind of edit."""
    import random

    from tests.llm.conftest import prose

    rng, out = random.Random(8), []
    for i in range(160):
        w = prose(rng, rng.randrange(60, 300)).split()
        n, k = len(w), rng.randrange(len(w) // 12, len(w) // 4)
        other = prose(rng, k).split()
        copy = [w[: n - k], w + other, w[: n // 2] + other + w[n // 2 :], [*w[: n // 3], *other[: k // 2], *w[n // 3 + k // 2 :]]][i % 4]
        a, b = ({tuple(x[j : j + 5]) for j in range(len(x) - 4)} for x in (w, copy))
        out.append((" ".join(w), " ".join(copy), len(a & b) / len(a | b)))
    return out


def edited_components(spark, **near):
    import corpus_pipeline

    pairs = edited_pairs()
    rows = [(2 * i + j, p[j]) for i, p in enumerate(pairs) for j in (0, 1)]
    got = {r.doc_id: r.component_id for r in simhash.simhash_components(spark.createDataFrame(rows, "doc_id long, text string"), **{**corpus_pipeline.NEAR, **near}).collect()}
    return [(s, got[2 * i + 1] == got[2 * i] == 2 * i) for i, (_, _, s) in enumerate(pairs)]


def test_candidates_of_every_edit(spark):
    """No copy of 0.8 or more is lost where a block of text was cut off, appended, inserted or replaced."""
    got = edited_components(spark, sketch_distance=80)
    assert all(linked for s, linked in got if s >= 0.8) and sum(s >= 0.8 for s, _ in got) > 60


@pytest.mark.parametrize("block_bytes", [8 << 20, 4096])
def test_links_are_exact(spark, monkeypatch, block_bytes):
    """Copies below 0.8 stay, those of 0.8 or more are linked, also where a component is cut into blocks."""
    monkeypatch.setattr(simhash, "VERIFY_BYTES", block_bytes, raising=False)
    got = edited_components(spark)
    assert all(linked == (s >= 0.8) for s, linked in got) and 20 < sum(s < 0.8 for s, _ in got) < 140


@pytest.mark.parametrize("block_bytes", [1 << 20, 6000, 2500])
def test_families_of_copies(spark, monkeypatch, block_bytes):
    """Families and chains of copies, of which most or few are similar to the pivot: their components as by brute force."""
    import random

    import corpus_pipeline
    from tests.llm.conftest import prose

    rng, texts = random.Random(12), []
    for family in range(4):
        base = prose(rng, 120).split()
        for _ in range(30):
            if family % 2:  # a chain: each is a copy of the one before
                base = base[3:] + prose(rng, 3).split()
                texts.append(" ".join(base))
            else:
                k = rng.randrange(1, 30)
                texts.append(" ".join(base[: len(base) - k] + prose(rng, k).split()))
    texts += [prose(rng, 80) for _ in range(10)]
    rng.shuffle(texts)
    sets = [{tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for t in texts]
    label = plain_components(sets, lambda a, b: 5 * len(a & b) >= 4 * len(a | b))
    monkeypatch.setattr(simhash, "VERIFY_BYTES", block_bytes)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.simhash_components(docs, **corpus_pipeline.NEAR).collect()}
    assert [got[i] for i in range(len(texts))] == label and 12 < len(set(label)) < 100


def test_similar():
    rng = np.random.default_rng(4)
    base = [np.unique(rng.integers(0, 1 << 60, 40).astype(np.uint64)) for _ in range(6)]
    sets = [np.concatenate([b[k:], rng.integers(0, 1 << 60, k // 2).astype(np.uint64)]) for b in base for k in rng.integers(0, 12, 9)] + [np.array([7], np.uint64), np.arange(4, dtype=np.uint64), np.arange(5, dtype=np.uint64)]
    order = rng.permutation(len(sets))
    sets = [sets[i] for i in order]
    near = lambda a, b: 5 * len(np.intersect1d(a, b)) >= 4 * len(np.union1d(a, b))
    assert simhash.similar(sets, 0.8).tolist() == plain_components(sets, near)
    assert simhash.similar(sets[:1], 0.8).tolist() == [0]


def test_spanning_stars():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 300, 200), rng.integers(0, 300, 200)
    n, root = spanning_stars(a, b)
    at = dict(zip(n.tolist(), root.tolist(), strict=True))
    label = plain_components(list(range(300)), lambda x, y: ((a == x) & (b == y)).any() or ((a == y) & (b == x)).any())
    assert [at.get(x, x) for x in range(300)] == label


# ------------------------------------------------------------------ 5, 8, 9


@pytest.fixture(scope="module")
def labelled(spark):
    import random

    rng = random.Random(4)
    docs, labels = [], []
    from tests.llm.conftest import prose

    for i in range(900):
        toxic, good = rng.random() < 0.2, rng.random() < 0.8
        words = prose(rng, rng.randrange(30, 120)).split()
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["zworst", "zworsten", "qevil"])
        if not good:
            words = [w.upper() + "!!" for w in words]
        docs.append((i, " ".join(words), "l", "s"))
        if rng.random() < 0.6:
            labels.append((i, int(good), int(toxic)))
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").repartition(4).persist()
    truth = {i: (int("!!" not in t), int("zworst" in t.lower() or "qevil" in t.lower())) for i, t, *_ in docs}
    return d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), truth


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_classifiers(spark, labelled, documents, no_documents, kind):
    d, labels, truth = labelled
    score = (lambda x: quality.score_quality(x, labels)) if kind == "quality" else (lambda x: toxicity.score_toxicity(x, toxicity.train(d, labels)))
    rows = score(d).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows) and len(held) > 200
    right = sum(r.predicted == truth[r.doc_id][kind == "toxic"] for r in held) / len(held)
    assert right > 0.95 and all(0 <= r.score <= 1 for r in rows)
    # labels of held-out rows change nothing
    flipped = labels.withColumn(kind, F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, 1 - F.col(kind)).otherwise(F.col(kind)))
    other = quality.score_quality(d, flipped) if kind == "quality" else toxicity.score_toxicity(d, toxicity.train(d, flipped))
    assert sorted(rows) == sorted(other.collect())
    assert score(no_documents if kind == "toxic" else no_documents.select("doc_id", "text")).count() == 0
    none = quality.score_quality(documents, labels.filter("false")) if kind == "quality" else toxicity.score_toxicity(documents, toxicity.train(documents, labels.filter("false")))
    assert none.filter("predicted = 1").count() == 0 and none.count() == documents.count()
    if kind == "toxic":
        kept = toxicity.drop_toxic(documents.limit(40).union(documents.filter("text is null")), toxicity.train(d, labels))
        assert kept.schema == documents.schema and kept.count() == 41 - documents.limit(40).filter("text is null").count() + documents.limit(40).filter("text is null").count()


def test_language(spark, no_documents):
    import random

    rng = random.Random(8)
    words = {"aa": ["the", "and", "of", "this"], "bb": ["der", "und", "für", "nicht"], "cc": ["les", "été", "où", "que"]}
    rows = [(i, " ".join(rng.choice(words[k]) + rng.choice(["", "n", "s"]) for _ in range(rng.randrange(3, 60))), k) for i in range(600) for k in [rng.choice("abc") * 2]]
    rows += [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 34 !!", "bb"), (1003, "der und nicht", None), (1004, "the and " * 5000, "aa")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(d).collect()}
    held = [r for r in rows if r[0] < 600 and got[r[0]].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in rows)
    assert sum(got[i].lang_pred == k for i, _, k in held) / len(held) > 0.97
    assert [got[i].lang_pred for i in (1000, 1001, 1002, 1003, 1004)] == ["und", "und", "und", "bb", "aa"]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.identify(d.filter("false")).count() == 0
    assert {r.lang_pred for r in langid.identify(d.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_many_languages_and_long_texts(spark, monkeypatch):
    """300 languages, one of long texts only, one frequent: each is learned, in one pass."""
    rng = random.Random(3)
    rows = [(i, " ".join("".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(4)) + f" lang{k}", f"l{k:03}") for i, k in enumerate(x for x in range(300) for _ in range(3))]
    rows += [(2000 + i, "long words only " * 40 + "x" * i, "long") for i in range(6)] + [(3000 + i, "very frequent one", "often") for i in range(900)]
    rows += [(5000, "", "empty"), (5001, None, "null"), (5002, "no language", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts, langs = langid.sample(d, 30, 100)
    learned = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2 and r[1] and r[2]]
    assert set(langs) == {r[2] for r in learned} and len(set(langs)) > 290
    assert [t for t, k in zip(texts, langs, strict=True) if k == "long"] == [min((r[1] for r in learned if r[2] == "long"), key=len).encode()[:100]]
    assert len(langs) == len(set(langs)) and max(Counter(langid.sample(d, 3000, 100)[1]).values()) == 3000 // len(set(langs))
    model = langid.Model(texts, langs)
    assert len(model.landmarks) == len(set(langs))
    monkeypatch.setattr(langid, "ALL_LANDMARKS", 50)
    assert len(langid.Model(texts, langs).landmarks) == 50
    same = spark.createDataFrame([(1, "rows that are all alike", "one")] * 40, "doc_id long, text string, lang string")
    assert langid.sample(same, 1, 100)[1] == ["one"]
    monkeypatch.setattr(langid, "LANGUAGES", 20)
    few = langid.sample(d, 30, 100)[1]
    assert len(set(few)) == 20 and "often" in few
    monkeypatch.undo()
    clash = d.union(d).select("doc_id", "text", "lang", F.lit("x").alias("n"), F.lit(1).alias("size"), F.lit(2).alias("k"))
    assert set(langid.sample(clash, 30, 100)[1]) == set(langs) and langid.identify(clash).count() == 2 * len(rows)


def test_kernel_ridge_by_hand():
    """Kernels from sets of n-grams, and the ridge solution from its normal equations, against the model's."""
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdé XYZ") for _ in range(rng.randrange(1, 30))).encode() for _ in range(24)]
    langs = [rng.choice(["p", "q", "r"]) for _ in texts]

    def grams(text, n):
        text = bytes(c + 32 if 65 <= c <= 90 else c for c in text)
        out = set()
        for i in range(len(text) - n + 1):
            code = int.from_bytes(text[i : i + n], "big")
            out.add(code if n == 1 else (code * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - langid.WIDTHS[n - 1].bit_length() + 1))
        return out

    def kernel(a, b):
        total = 0
        for n in (1, 2, 3, 4):
            x, y = grams(a, n), grams(b, n)
            total += len(x & y) / math.sqrt(max(len(x), 1) * max(len(y), 1)) / 4
        return total

    model = langid.Model(texts, langs)
    k = np.array([[kernel(a, b) for b in texts] for a in texts])
    own = langid.presence(*column_bytes(pa.array(texts, pa.binary())))
    assert np.allclose(own @ own.T, k, atol=1e-5)
    # all texts are landmarks here: the Nystroem space is the kernel's own, so the dual problem has the same solution
    weight = np.diag([1 / langs.count(x) for x in langs])
    target = np.array([[1.0 if x == m else -1.0 for m in "pqr"] for x in langs])
    n = len(texts)
    both = np.block([[k @ weight @ k + langid.RIDGE * k, (k @ weight @ np.ones((n, 1)))], [np.ones((1, n)) @ weight @ k, np.array([[weight.sum() + langid.RIDGE * 1e-6]])]])
    solved = np.linalg.lstsq(both, np.vstack([k @ weight @ target, np.ones((1, n)) @ weight @ target]), rcond=1e-9)[0]
    assert np.allclose(k @ solved[:-1] + solved[-1], own @ model.landmarks.T @ model.dual + model.bias, atol=0.02)


def test_risk_by_hand():
    """The non-negative risk, its gradient by differences in both branches, and training against a slow version."""
    rng = np.random.default_rng(2)
    loss = lambda z: math.log1p(math.exp(-z))
    for prior, low in ((0.3, False), (0.9, True)):
        zp, zu = rng.normal(1 if not low else 3, 1, 7), rng.normal(0 if not low else -4, 1, 9)
        first = prior * sum(loss(z) for z in zp) / 7
        second = sum(loss(-z) for z in zu) / 9 - prior * sum(loss(-z) for z in zp) / 7
        assert np.allclose(pu.risk(zp, zu, prior), (first, second)) and (second < 0) == low
        gp, gu = pu.slopes(zp, zu, prior)
        goal = (lambda a, b: -pu.risk(a, b, prior)[1]) if low else (lambda a, b: sum(pu.risk(a, b, prior)))  # noqa: B023
        for g, z, at in ((gp, zp, 0), (gu, zu, 1)):
            for i in range(len(z)):
                up, down = z.copy(), z.copy()
                up[i] += 1e-5
                down[i] -= 1e-5
                args = [[up, zu], [down, zu]] if at == 0 else [[zp, up], [zp, down]]
                assert abs((goal(*args[0]) - goal(*args[1])) / 2e-5 - g[i]) < 1e-6
    xp, xu = (rng.random((30, 4)) < [0.9, 0.2, 0.5, 0.1]).astype(np.float32), (rng.random((60, 4)) < [0.4, 0.5, 0.5, 0.1]).astype(np.float32)
    w, b = [0.0] * 4, 0.0
    m, v = [0.0] * 5, [0.0] * 5
    for t in range(1, 201):  # Adam, written out
        zp, zu = [sum(x * y for x, y in zip(r, w, strict=True)) + b for r in xp.tolist()], [sum(x * y for x, y in zip(r, w, strict=True)) + b for r in xu.tolist()]
        s = lambda z: 1 / (1 + math.exp(-z))
        fine = sum(loss(-z) for z in zu) / 60 - 0.3 * sum(loss(-z) for z in zp) / 30 >= 0
        gp = [(0.3 * (s(z) - 1) - 0.3 * s(z) if fine else 0.3 * s(z)) / 30 for z in zp]
        gu = [(s(z) if fine else -s(z)) / 60 for z in zu]
        g = [sum(a * r[j] for a, r in zip(gp, xp.tolist(), strict=True)) + sum(a * r[j] for a, r in zip(gu, xu.tolist(), strict=True)) + 3e-4 * w[j] for j in range(4)] + [sum(gp) + sum(gu)]
        m, v = [0.9 * x + 0.1 * y for x, y in zip(m, g, strict=True)], [0.999 * x + 0.001 * y * y for x, y in zip(v, g, strict=True)]
        step = [0.05 * (x / (1 - 0.9**t)) / (math.sqrt(y / (1 - 0.999**t)) + 1e-8) for x, y in zip(m, v, strict=True)]
        w, b = [x - y for x, y in zip(w, step[:4], strict=True)], b - step[4]
    got, bias = pu.fit(xp, xu, 0.3, steps=200)
    assert np.allclose(got, w, atol=1e-3) and abs(bias - b) < 1e-3


def test_samples_of_huge_tables(spark):
    """The share of rows that is kept is never rounded to none, however many rows there are."""
    ids = spark.range(0, 100_000).withColumnRenamed("id", "doc_id")
    assert 4_500 < ids.filter(pu.kept_by_hash(100_000, 4_000)).count() < 5_500
    assert ids.filter(pu.kept_by_hash(10, 4_000)).count() == 100_000
    text = pu.kept_by_hash(10**13, 4_000)._jc.toString()
    assert int(re.findall(r"\d+", text)[-1]) > 10**6


def auc(rows):
    order = sorted(rows)
    ranks, i = {}, 0
    while i < len(order):
        j = i
        while j < len(order) and order[j][0] == order[i][0]:
            j += 1
        ranks[order[i][0]] = (i + j + 1) / 2
        i = j
    up = [s for s, y in rows if y]
    return (sum(ranks[s] for s in up) - len(up) * (len(up) + 1) / 2) / (len(up) * (len(rows) - len(up)))


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_scores_of_long_and_repeated_texts(spark, labelled, kind):
    """Held-out AUC; a text that repeats scores alike; a text of a million words is scored whole."""
    d, labels, truth = labelled
    model = None if kind == "quality" else toxicity.train(d, labels)
    score = lambda x: quality.score_quality(x, labels) if model is None else toxicity.score_toxicity(x, model)
    rows = score(d).collect()
    assert auc([(r.score, truth[r.doc_id][kind == "toxic"]) for r in rows if r.held_out]) > 0.98
    by_text = {}
    texts = d.select("doc_id", "text")
    bad = next(r for r in d.collect() if truth[r.doc_id][1])
    long = spark.createDataFrame([(10**6, "plain words " * 200_000 + bad.text), (10**6 + 1, "plain words " * 200_000)], "doc_id long, text string")
    both = texts.union(texts).union(long).withColumn("n", F.lit(1)).withColumn("score", F.lit("x"))
    text_of = {r.doc_id: r.text for r in texts.collect()}
    for r in score(both).collect():
        if r.doc_id < 10**6:
            assert by_text.setdefault(text_of[r.doc_id], r.score) == r.score
        else:
            by_text[r.doc_id] = r.score
    a, b = by_text[10**6], by_text[10**6 + 1]
    assert a > b if kind == "toxic" else a != b


ODD_TEXTS = ["", " \n\t ", "One two, TWO two! one\nline | two\nline | two\n\nthree", "Ünï cødé 日本 $5 #tag a=b", "x", "same same same " * 30, "a.b-c:d;e 12345 ABCdef $$$ ok!\r\n(no)", "toxictoxic Toxicword toxi", "caf\xe9 caf\u00e9s long" + "g" * 300]


def slow_measures(text):
    """The measures of one text, as they are described."""
    raw = text.encode()
    n, w, lines = max(len(raw), 1), raw.split(), [x for x in raw.split(b"\n") if x]
    groups = {k: set(v) for k, v in quality.CLASSES.items()}
    kind = {c: next((k for k in groups if c in groups[k]), "rest") for c in range(256)}  # the classes have no byte in common
    share = [sum(kind[c] == k for c in raw) / n for k in [*groups, "rest"]]
    per, size = max(len(w), 1), [len(x) for x in w]
    mean = sum(size) / per
    distinct = len(set(w))
    return [*share, math.log1p(len(w)), distinct / per, math.log1p(distinct) / math.log1p(per), sum(x == y for x, y in zip(w, w[1:], strict=False)) / per, mean, math.sqrt(max(sum(x * x for x in size) / per - mean**2, 0)), math.log1p(max(size, default=0)),
            sum(x[-1:] in [bytes([c]) for c in b"!#$%&*|=+~^<>"] for x in w) / per, len(lines) / per, len(set(lines)) / max(len(lines), 1), share[0] / max(share[0] + share[1], 1e-9)]


def tokens_in(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode()))


def hash_of(word):
    data, offsets = column_bytes(pa.array([word], pa.binary()))
    return common.span_hash(common.byte_sums(data), offsets[:-1], offsets[1:])[0]


def test_quality_by_hand():
    """Measures, hashed words and pairs, bins and the score, one text at a time."""
    data, offsets = column_bytes(pa.array([t.encode() for t in ODD_TEXTS], pa.binary()))
    m = quality.measures(data, offsets)
    assert np.allclose(m, [slow_measures(t) for t in ODD_TEXTS], atol=1e-9)
    g = quality.grams(data, offsets)
    want = np.zeros_like(g)
    for i, t in enumerate(ODD_TEXTS):
        h = np.array([hash_of(w) for w in tokens_in(t)], U)
        for x in [*h, *(common.gram_hash(h[k : k + 2], 2)[0] for k in range(len(h) - 1))]:
            want[i, int(x) % quality.GRAMS] += 1
        want[i] /= max(np.sqrt((want[i] ** 2).sum()), 1)
    assert np.allclose(g, want, atol=1e-6)
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["alpha", "beta", "Gamma!", "x", "$"]) for _ in range(rng.randrange(1, 60))) for _ in range(80)]
    model = quality.Model([t.encode() for t in texts[:40]], [t.encode() for t in texts[20:]], 0.4)
    z = []
    for i in range(len(ODD_TEXTS)):
        hot = np.zeros((m.shape[1], len(model.edges) + 1))
        for k in range(m.shape[1]):
            hot[k, sum(e < m[i, k] for e in model.edges[:, k])] = 1
        z.append(hot.ravel() @ model.weights[: -quality.GRAMS] + want[i] @ model.weights[-quality.GRAMS :] + model.bias)
    assert np.allclose(model.score(data, offsets), 1 / (1 + np.exp(-np.array(z))), atol=1e-5)


def test_toxicity_by_hand():
    """Words and beginnings of words, which are kept, and the score, one text at a time."""
    def plain(text):
        out = set()
        for w in tokens_in(text):
            out |= {(0, w)} | {(n, w[:n]) for n in toxicity.STEMS if len(w) >= n}
        return out

    code = lambda f: hash_of(f[1]) if not f[0] else common.mix(np.array([hash_of(f[1])], U) + U(f[0]))[0]
    doc, h = toxicity.per_text([t.encode() for t in ODD_TEXTS])
    for i, t in enumerate(ODD_TEXTS):
        assert sorted(h[doc == i].tolist()) == sorted(int(code(f)) for f in plain(t)), t
    rng = random.Random(2)
    words = ["good", "plain", "day", "tree", "river"]
    clean = [" ".join(rng.choice(words) for _ in range(20)) for _ in range(120)]
    bad = [" ".join([*t.split()[:10], rng.choice(["toxicword", "toxicstuff"])]) for t in clean[:40]]
    model = toxicity.Model([t.encode() for t in bad[:30]], [t.encode() for t in clean + bad[30:]], 0.1)
    kept = set(model.hashes.tolist())
    names = {int(code(f)): f for t in clean + bad for f in plain(t)}
    assert kept and {names[x][1][:3] for x in kept} == {b"tox"}  # what clean texts hold too is no feature
    everything = ODD_TEXTS + clean[:5] + bad
    z = [sum(float(model.weights[model.hashes.tolist().index(int(code(f)))]) for f in plain(t) if int(code(f)) in kept) + model.bias for t in everything]
    got = model.score(*column_bytes(pa.array([t.encode() for t in everything], pa.binary())))
    assert np.allclose(got, 1 / (1 + np.exp(-np.array(z))), atol=1e-5) and got[-1] > 0.7 > got[len(ODD_TEXTS)]


def test_scratch_needs_a_shared_folder(spark):
    class Cluster:
        conf = type("conf", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("sc", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.scratch_root(Cluster)
