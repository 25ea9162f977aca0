"""Operators over the whole corpus, against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lectern.llm import blocks, fmindex, itq, lm, packing, resample, simhash, substrings
from lectern.llm.common import connected_components

xxhash = pytest.importorskip("xxhash")
public_tokenizers = pytest.importorskip("public_tokenizers")


def components(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_connected_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(400, k) for k in range(401, 450)]
    want = components(500, links)
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame([*links, (5, 5), (None, 3)], "u long, v long")).collect()}
    assert got == {i: want[i] for a, b in links if a != b for i in (a, b)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# ---- SimHash


def slow_print(t):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, as_tables, docs, rows, none):
    got = sorted(map(tuple, simhash.op3_simhash(spark, as_tables(documents=docs)).collect()), key=str)
    fp = [slow_print(t) for _, t in rows]
    ids = [i for i, _ in rows]
    part = components(len(rows), [(a, b) for a in range(len(fp)) for b in range(a) if (fp[a] ^ fp[b]).bit_count() <= 3])
    least = {}
    for i, p in zip(ids, part, strict=True):
        least[p] = min(least.get(p, 1 << 62), 1 << 62 if i is None else i)
    assert got == sorted([(i, f"{f:016x}", least[p]) for i, f, p in zip(ids, fp, part, strict=True)], key=str)
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("tile", [3, 1024])
def test_every_close_pair_is_linked(spark, tile):
    """A hot ball of fingerprints, cut in small tiles."""
    rng = random.Random(2)
    centre, prints = rng.getrandbits(64), set()
    for _ in range(150):
        x = centre
        for _ in range(rng.randrange(6)):
            x ^= 1 << rng.randrange(64)
        prints.add(x)
    prints |= {rng.getrandbits(64) for _ in range(50)}
    prints = sorted(prints)
    signed = [(x - (1 << 64) if x >> 63 else x, i) for i, x in enumerate(prints)]
    edges = simhash.edges(spark.createDataFrame(signed, "fp long, rep long"), tile)
    got = components(len(prints), [(r["u"], r["v"]) for r in edges.collect()])
    assert got == components(len(prints), [(a, b) for a in range(len(prints)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3])


# ---- repeated windows


def slow_removed(rows, window=13):
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            first[k] = min(first.get(k, 1 << 63), (1 << 63) - 1 if i is None else i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < ((1 << 63) - 1 if i is None else i):
                gone[s : s + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_repeated_windows(spark, as_tables, docs, rows, none):
    got = substrings.op4_substrings(spark, as_tables(documents=docs)).collect()
    assert sorted(map(tuple, got), key=str) == slow_removed(rows)
    assert sum(r["n_removed"] for r in got) > 0
    assert substrings.remove_repeats(none).count() == 0


@pytest.mark.parametrize(("hot", "group"), [(1, 1024), (substrings.HOT, 2), (1, 2)])
def test_hot_anchors_and_merged_groups_change_nothing(monkeypatch, docs, rows, hot, group):
    """With every shared anchor hot, single windows are dealt; with groups of two blocks, their keys are merged first."""
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 30_000)
    out = substrings.remove_repeats(docs, hot, group)
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in out.collect()), key=str) == slow_removed(rows)


@pytest.mark.parametrize("group", [1, 3, 100])
def test_tally(spark, monkeypatch, group):
    """Sums over all blocks, replied to each of them, by either route."""
    monkeypatch.setattr(blocks, "RANGES", 2)
    rng = random.Random(group)
    rows = [(b, " ".join(str(rng.randrange(40)) for _ in range(rng.randrange(30)))) for b in range(10)]
    blocked = spark.createDataFrame(rows, "block int, text string")

    def ask(r):
        return np.unique(np.array([int(x) for t in r["text"] for x in t.split()], np.uint64), return_counts=True)

    replies, parts = blocks.tally(blocked, 10, 2, ask, lambda k, s: (s * 2).astype(np.int16), lambda k, s: np.array([s.sum(), len(k)], np.int64), group)
    got = replies.collect()
    total = Counter(x for _, t in rows for x in map(int, t.split()))
    for b, t in rows:
        keys = np.unique(np.array([int(x) for x in t.split()], np.uint64))
        mine = [r for r in got if r["block"] == b]
        assert blocks.replied(keys, parts, [r["part"] for r in mine], [r["values"] for r in mine], np.int16).tolist() == [2 * total[int(k)] for k in keys]
    assert sum(np.frombuffer(r["values"], np.int64) for r in got if r["block"] < 0).tolist() == [sum(total.values()), len(total)]


def test_runs_do_not_depend_on_the_order_of_rows(rows):
    from lectern.llm.words import of_texts

    some = [(i, t) for i, t in rows if i is not None][:60]
    _, _, _, h, sizes = of_texts([t for _, t in some])
    _, place, g, position, windows = substrings.own_anchors(h, sizes)
    assert np.repeat(position, windows).tolist() == place.tolist() and (np.diff(position) > 0).all()
    keys = np.unique(g[position])
    told = [1], [bytes(np.where(keys[keys % np.uint64(2) == 1] % np.uint64(3) == 0, substrings.OFTEN, substrings.SHARED).astype(np.uint8))]
    cut = lambda x: substrings.cut([i for i, _ in x], [t for _, t in x], told, 2, 3)
    one, other = cut(some), cut(some[::-1])
    assert {s: found for s, (_, _, found) in one.by_shard.items()} == {s: found for s, (_, _, found) in other.by_shard.items()}
    docs = lambda r: {s: sorted(zip(which.tolist(), r.doc[places].tolist(), r.windows[places].tolist())) for s, (places, which, _) in r.by_shard.items()}
    assert docs(one) == docs(other)


def colliding_words():
    """Words whose polynomial hashes modulo 2 ** 64 are equal for every base."""
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    return a, b


def test_words_are_told_apart_by_their_bytes(spark, as_tables):
    a, b = colliding_words()
    rows = [(1, " ".join([a] * 20)), (2, " ".join([b] * 20)), (3, " ".join([a] * 14)), (4, f"{a} {b} " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substrings.op4_substrings(spark, as_tables(documents=docs)).collect()
    assert sorted(map(tuple, got), key=str) == slow_removed(rows)
    scores = {r["doc_id"]: r for r in lm.score(docs.where("doc_id < 3")).collect()}
    assert scores[1]["n_tokens"] == 21 and scores[1]["base_score"] == pytest.approx(scores[2]["base_score"])
    assert scores[1]["base_score"] == pytest.approx(20 * math.log10(20.1 / 42.4) + math.log10(2.1 / 42.4))


def test_equal_hashes_do_not_make_equal_words():
    """Whatever the hash says, a shard numbers words by their bytes."""
    found = [" ".join(f"w{i}" for i in range(k, k + 15)).encode() for k in (0, 1, 40)] + [" ".join(["w0", "x", *(f"w{i}" for i in range(2, 15))]).encode()]
    least, begin = substrings.first_documents(found, np.array([5, 3, 2, 1]))
    assert [least[s:e].tolist() for s, e in zip(begin, begin[1:])] == [[5, 3, 1], [3, 1, 3], [2, 2, 2], [1, 1, 1]]


def test_rows_keep_their_columns_and_own_texts(spark, docs, rows, none):
    out = substrings.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    want = {(i, n, r, d) for i, n, r, d in slow_removed(rows)}
    for r in out.collect():
        t = r["text"]
        assert r["n_chars"] == len(t or "") and r["spans"] == [1]
        assert any(i == r["doc_id"] and d == hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest() for i, _, _, d in want)
    assert substrings.without_repeats(none).count() == 0


def test_fm_index():
    rng = np.random.default_rng(3)
    text = np.append(rng.integers(1, 700, 5000) ** 2 // 300 + 1, 0)
    text[rng.integers(0, 5000, 40)] = 0
    text[2000:2300] = text[100:400]
    values = rng.integers(0, 50, len(text)) - 20
    index = fmindex.FmIndex(text, 16, values)
    assert index.tree.nbytes() - index.tree.starts.nbytes < 2.5 * len(text)  # 11 levels
    ends = np.arange(len(text))
    length, lo, hi = index.matching(text, ends, 13, batch=700)
    for e in rng.integers(0, 5000, 200).tolist() + list(range(2000, 2020)):
        want = 0
        while want < 13 and e - want >= 0:
            p = text[e - want : e + 1]
            if (p == 0).any() or sum((text[i : i + len(p)] == p).all() for i in range(len(text) - len(p) + 1)) < 2:
                break
            want += 1
        assert length[e] == want
        if want:
            p = text[e - want + 1 : e + 1]
            at = [i for i in range(len(text) - want + 1) if (text[i : i + want] == p).all()]
            assert hi[e] - lo[e] == len(at) and index.least(lo[e : e + 1], hi[e : e + 1])[0] == min(values[i] for i in at)
    assert (length == 13).sum() >= 280


# ---- language model


def test_scores(spark, as_tables, docs, rows):
    got = {(r["doc_id"], r["n_tokens"]): r for r in lm.op7_lm(spark, as_tables(documents=docs)).collect()}
    tokens = [(i, [*(t or "").encode().lower().split(), None]) for i, t in rows]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tokens:
        r = got[i, len(ws)]
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), rel=1e-9)
        assert (r["n_known"], r["train_tokens"], r["held_out"]) == (sum(w in c for w in ws), n, held(i))
        assert r["score"] < 0


@pytest.mark.parametrize(("n", "group"), [(20, 1024), (200, 1024), (200, 1), (800, 1024)])
def test_every_training_pair_counts(spark, monkeypatch, n, group):
    """Scores against a brute-force model, at several sizes of the corpus: a rare word still is a context, and the route of the counts
    changes nothing."""
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 300_000)
    rng = random.Random(13)
    rows = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(3000))) for i in range(n)]
    rows += [(1000 + i, f"w1 rare{i // 2} next{i // 2} w2") for i in range(40)]
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    tokens = [(i, ["", *t.split(), None]) for i, t in rows]
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    pairs = Counter(p for i, ws in tokens if not held(i) for p in zip(ws, ws[1:]))
    total, v = sum(c.values()) - c[""], len(c) - 1
    got = {r["doc_id"]: r for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string"), group).collect()}
    for i, ws in tokens[-60:]:
        want = base = 0
        for u, w in zip(ws, ws[1:]):
            p = (c[w] + 0.1) / (total + 0.1 * (v + 1))
            low = 2.0 ** (math.floor(2 * math.log2(pairs[u, w]) + 1e-9) / 2) if pairs[u, w] else 0
            want += math.log10(lm.MIX * low / c[u] + (1 - lm.MIX) * p if c[u] else p)
            base += math.log10(p)
        assert got[i]["base_score"] == pytest.approx(base, rel=1e-9) and got[i]["train_tokens"] == total
        assert got[i]["score"] == pytest.approx(want, rel=2e-3, abs=0.05)


def test_bloom_filter_never_undercounts():
    rng = np.random.default_rng(4)
    codes, counts = np.arange(2000), rng.integers(1, 5000, 2000)
    q, bits = lm.levels(counts, 1.0), np.zeros((2, lm.SEGMENT_BITS // 8), np.uint8)
    for j in range(1, int(q.max()) + 1):
        segment, at = lm.places(codes[q >= j], j, 2)
        np.bitwise_or.at(bits, (segment, at >> 3), (1 << (at & 7)).astype(np.uint8))
    model = lm.Filter(bits, 1.0)
    got = model.count(codes)
    assert (got >= 2.0 ** ((q - 1) / 2) * 0.999).all() and (got <= counts * 1.001).mean() > 0.97
    assert (model.count(np.arange(10_000, 12_000)) > 0).mean() < 0.03


# ---- quality


def test_quality(spark, none):
    rng = random.Random(6)
    good, bad = "the of and to in that is was for it".split(), "### &&& $$$ %%% ***".split()
    rows = [(i, " ".join(rng.choices(good if i % 4 else bad, k=60))) for i in range(400)] + [(900, None), (901, "")]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 400, 2)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r["kept"] for r in resample.resample(docs, labels).collect()}
    assert len(out) == 402
    held = [i for i in range(400) if i % 2]
    assert sum(out[i] == (i % 4 > 0) for i in held) / len(held) > 0.97
    assert resample.resample(docs, labels, k=10).where("kept").count() == 10
    assert resample.resample(docs, labels.limit(0)).where("kept").count() == 402
    assert resample.resample(none, labels).count() == 0


def test_quality_query_is_the_brute_force_draw(spark, as_tables, docs, rows):
    """Counts, ratios, weights, threshold and draw one by one; only the noise comes from the same hash of the id."""
    import re

    labels = [(i, int(i % 3 > 0), int(i % 10 == 1)) for i, _ in rows if i is not None and i < 60] + [(5, 0, 0), (None, 1, 0), (6, None, 0)]
    got = resample.op1_quality(spark, as_tables(documents=docs, labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))).collect()

    def buckets(t):
        tokens = [zlib.crc32(x.encode()) for w in (t or "").split() for x in re.findall(r"\w+|[^\w\s]+", w)]
        return [x % resample.BUCKETS for x in tokens] + [(((a * 0x9E3779B1 + b * 0x85EBCA77) % 2**64 if a * 0x9E3779B1 + b * 0x85EBCA77 < 2**63 else a * 0x9E3779B1 + b * 0x85EBCA77 - 2**64) >> 7) % resample.BUCKETS for a, b in zip(tokens, tokens[1:])]

    good = {}
    for i, q, t in labels:
        if i is not None and q is not None:
            good[i] = good.get(i, True) and q > 0 and not t
    assert len(good) < resample.LABELLED
    held = {i: g for i, g in good.items() if zlib.crc32(str(i).encode()) % 4 == 0}
    raw = Counter(b for _, t in rows for b in buckets(t))
    target = Counter(b for i, t in rows if good.get(i) and i not in held for b in buckets(t))
    scale = sum(target.values()) / sum(raw.values())
    weight = [sum(math.log((target[b] + 20) / (raw[b] * scale + 20)) for b in buckets(t)) for _, t in rows]
    noise = {r["doc_id"]: r["h"] for r in docs.selectExpr("doc_id", "xxhash64(doc_id, 17) as h").collect()}
    key = [w - math.log(-math.log((((noise[i] % 2**64) >> 11) + 0.5) / 2**53)) for w, (i, _) in zip(weight, rows, strict=True)]
    known = {}
    for w, (i, _) in zip(weight, rows, strict=True):
        if i in held:
            known[i] = min(w, known.get(i, w))
    scores = sorted((w, held[i]) for i, w in known.items())
    told = lambda bar: sum(g for w, g in scores if w >= bar) / sum(g for _, g in scores) + sum(not g for w, g in scores if w < bar) / sum(not g for _, g in scores)
    best = max((told(w), -k) for k, (w, _) in enumerate(scores))[1]
    bar = (scores[-best][0] + (scores[-best - 1][0] if best else scores[0][0] - 1)) / 2
    k = sum(w >= bar for w in weight)
    least = sorted(key, reverse=True)[k - 1]
    want = [(i, w) for w, x, (i, _) in zip(weight, key, rows, strict=True) if x >= least]
    assert 0 < len(want) < len(rows)
    shown = lambda x: sorted((str(i), round(w, 2)) for i, w in x)
    assert shown(map(tuple, got)) == shown(want)


def test_kth_largest(spark):
    df = spark.createDataFrame([(x * x * x - 5000,) for x in range(-300, 300)], "v long")
    values = sorted((r["v"] for r in df.collect()), reverse=True)
    assert [resample.kth_largest(df, "v", k) for k in (1, 7, 333, 600)] == [values[k - 1] for k in (1, 7, 333, 600)]
    assert resample.kth_largest(df, "v", 0) is None


# ---- packing


def test_packing(spark, as_tables, docs, rows, none):
    lib = pytest.importorskip("tokenizers").Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.op5_packing(spark, as_tables(documents=docs)).collect()
    ids = {i: [*lib.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for i, own in ids.items():
        copies = sum(j == i for j, _ in rows)
        assert sum(r["length"] for r in pieces[i]) == copies * len(own)
        for r in pieces[i]:
            assert r["doc_tokens"] == len(own)
            assert r["ids_crc32"] == zlib.crc32(np.array(own[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
    padding = 0
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding < 0.05 * sum(r["length"] for r in got)
    assert packing.pack(none).count() == 0


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(7)
    for _ in range(20):
        pos = np.unique(np.concatenate([[0], np.cumsum(rng.integers(1, 9, 30))]))
        cost = rng.integers(0, 5, len(pos))
        window = 16
        best = [0] + [10**9] * (len(pos) - 1)
        for j in range(1, len(pos)):
            for i in range(j):
                size = pos[j] - pos[i]
                if size <= window:
                    pad = 0 if size & (size - 1) == 0 else window - size
                    best[j] = min(best[j], best[i] + pad + cost[j] + packing.SEQUENCE)
        origin, total = packing.cheapest(pos, cost, window)
        cuts = packing.way(origin, len(pos) - 1)
        assert total == best[-1] and cuts[0] == 0 and cuts[-1] == len(pos) - 1
        last = packing.common(origin, pos, window)
        assert all(last in packing.way(origin, j) for j in range(len(pos)) if pos[j] > pos[-1] - window)


@pytest.mark.parametrize("chunk", [1100, 3000, 9000])
def test_chunks_do_not_make_the_cuts_dearer(chunk):
    rng = np.random.default_rng(17)
    ends = np.zeros(400, bool)
    ends[:4] = True
    docs = [(i, rng.integers(0, 400, int(rng.choice([1, 7, 90, 600, 4000]))).astype(np.uint32).tobytes()) for i in range(60)]
    whole = np.frombuffer(b"".join(d for _, d in docs), np.uint32)
    pos, cost = packing.cut_points(whole, np.cumsum([len(d) // 4 for _, d in docs]), ends)
    _, best = packing.cheapest(pos, cost)
    sizes = Counter()
    for r in packing.pack_stream(iter(docs), ends, 0, chunk):
        sizes[r[5]] += r[2]
    at = np.cumsum([sizes[k] for k in sorted(sizes)])
    padding = sum(0 if n & (n - 1) == 0 else packing.WINDOW - n for n in sizes.values())
    assert padding + len(sizes) * packing.SEQUENCE + int(cost[np.searchsorted(pos, at)].sum()) == best


def test_long_documents_cross_chunks():
    ends = np.zeros(100, bool)
    ends[7] = True
    ids = np.random.default_rng(8).integers(0, 100, 5000).astype(np.uint32)
    out = list(packing.pack_stream(iter([(1, ids.tobytes()), (2, ids[:10].tobytes())]), ends, 0, chunk=1500))
    assert b"".join(r[3] for r in out if r[0] == 1) == ids.tobytes()
    assert [r[1] for r in out if r[0] == 1] == np.cumsum([0] + [r[2] for r in out if r[0] == 1])[:-1].tolist()


def test_empty_tables(spark, as_tables, none):
    folder = as_tables(documents=none, labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"), embeddings=spark.createDataFrame([], "vec_id long, embedding array<float>, label int"))
    for query in (resample.op1_quality, simhash.op3_simhash, substrings.op4_substrings, packing.op5_packing, lm.op7_lm, itq.op10_itq):
        assert query(spark, folder).count() == 0


# ---- embeddings


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(itq, "TILE", 16)
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((30, 24))
    x = np.concatenate([centres[rng.integers(0, 30, 300)] + 0.12 * rng.standard_normal((300, 24)), np.repeat(centres[:1], 40, axis=0), rng.standard_normal((100, 24))]).astype("f4")
    label = rng.integers(0, 3, len(x)).tolist()
    rows = [(i, v.tolist(), g, 1) for i, (v, g) in enumerate(zip(x, label, strict=True))]
    odd = [(1000, None, 1), (1001, [0.0] * 24, 1), (1002, [float("nan")] * 24, 1), (1003, x[0].tolist(), None), (1004, [None, *x[0, 1:].tolist()], 1), (1005, [], 1), (1006, [1.0, 2.0], 1), (1007, [2.0, 4.0], 1)]
    df = spark.createDataFrame([*rows, *((*r, 2) for r in odd)], "vec_id long, embedding array<float>, label int, n int").repartition(3)
    got = {r["vec_id"]: r for r in itq.near_vectors(df).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = (u @ u.T >= 0.93) & (np.array(label)[:, None] == np.array(label)[None])
    np.fill_diagonal(linked, False)
    found = sum(got[i]["n_links"] for i in range(len(x)))
    assert all(got[i]["n_links"] <= linked[i].sum() for i in range(len(x)))
    assert found >= 0.9 * linked.sum()
    part = components(len(x), list(zip(*np.nonzero(linked))))
    right = [got[i]["component_id"] == part[i] for i in range(len(x))]
    assert np.mean(right) > 0.97 and all(got[i]["component_id"] in np.flatnonzero(np.array(part) == part[i]) for i in range(len(x)))
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in range(len(x)))
    for i in (1000, 1001, 1002, 1003, 1004, 1005):
        assert tuple(got[i]) == (i, 0, i, True)
    assert tuple(got[1006]) == (1006, 1, 1006, True) and tuple(got[1007]) == (1007, 1, 1006, False)
    assert itq.near_vectors(df.where("vec_id < 0")).count() == 0
    # pairs are verified in double precision, and the codes lose few of them at any bits
    bits, tables = itq.shape(10**9)
    assert bits == 24 and tables < 120


@pytest.mark.parametrize("bits", [16, 24])
def test_recall_with_a_common_mean(spark, monkeypatch, bits):
    """Brute force over pairs just above the least cosine, at the substrings of large tables."""
    monkeypatch.setattr(itq, "PER_LIST", 600 / 2**bits)
    rng = np.random.default_rng(21)
    norm = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    one = np.eye(1, 32)
    x = 0.6 * one + 0.8 * norm(rng.standard_normal((300, 32)))
    x = norm(x)
    side = norm(rng.standard_normal((300, 32)))
    side = norm(side - (side * x).sum(axis=1, keepdims=True) * x)
    x = np.concatenate([x, 0.935 * x + np.sqrt(1 - 0.935**2) * side])
    u = norm(x)
    linked = u @ u.T >= 0.93
    np.fill_diagonal(linked, False)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = sum(r["n_links"] for r in itq.near_vectors(df).collect())
    assert 0.9 * linked.sum() <= got <= linked.sum()


@pytest.mark.parametrize(("n", "common"), [(300, 0.0), (3000, 0.3), (12_000, 0.5)])
def test_recall_at_sizes(spark, n, common):
    """Planted pairs just above the least cosine among unlike vectors, at several sizes and with a common mean; groups of copies and
    of near copies with them. Links and components against brute force."""
    rng = np.random.default_rng(n)
    norm = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    x = norm(common * np.eye(1, 48) + math.sqrt(1 - common**2) * norm(rng.standard_normal((n, 48))))
    side = norm(rng.standard_normal((n // 3, 48)))
    side = norm(side - (side * x[: n // 3]).sum(axis=1, keepdims=True) * x[: n // 3])
    cosine = rng.uniform(0.931, 0.97, (n // 3, 1))
    group = norm(x[:1] + 0.02 * rng.standard_normal((60, 48)))
    x = np.concatenate([x, cosine * x[: n // 3] + np.sqrt(1 - cosine**2) * side, group, np.repeat(x[1:2], 30, axis=0)])
    links, count = [], np.zeros(len(x), int)
    u = norm(x)
    for a in range(0, len(u), 1000):
        i, j = np.nonzero(u[a : a + 1000] @ u.T >= 0.93)
        i += a
        i, j = i[i != j], j[i != j]
        count += np.bincount(i, minlength=len(x))
        links += list(zip(i.tolist(), j.tolist()))
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in itq.near_vectors(df).collect()}
    own = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (own <= count).all() and own.sum() >= 0.9 * count.sum()
    pairs = count == 1
    assert own[pairs].sum() >= 0.9 * pairs.sum()
    part = components(len(x), links)
    assert np.mean([got[i]["component_id"] == part[i] for i in range(len(x))]) > 0.97
    print(f"{len(x)} vectors, mean {common}: {own.sum() / count.sum():.4f} of all links, {own[pairs].sum() / pairs.sum():.4f} of lone pairs")
