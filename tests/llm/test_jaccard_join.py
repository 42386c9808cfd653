import math

import numpy as np
import pytest

from rfmlens.llm import jaccard_join as jj
from rfmlens.llm._components import components
from rfmlens.llm.queries import queries


def shingles(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, k=3, num=90, den=100):
    """(doc_id, n, component) by comparing all pairs that share a shingle."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    seen = {}
    for at, (_, s) in enumerate(sets):
        for x in s:
            seen.setdefault(x, []).append(at)
    pairs = {(a, b) for at in seen.values() if len(at) > 1 for n, a in enumerate(at) for b in at[n + 1:]}
    for a, b in pairs:
        (i, s), (j, t) = sets[a], sets[b]
        if min(len(s), len(t)) * den >= max(len(s), len(t)) * num:
            both = len(s & t)
            if den * both >= num * (len(s) + len(t) - both):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i) if s else i) for i, s in sets)


def result(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def families(seed, n_families, top):
    """Texts with random edits: similarities all around the threshold."""
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n_families):
        base = [f"w{x}" for x in rng.integers(0, 400, rng.integers(1, top))]
        for _ in range(rng.integers(1, 9)):
            words = list(base)
            for _ in range(rng.integers(0, max(2, len(base) // 20 + 2))):
                at = rng.integers(0, len(words))
                words[at] = f"e{rng.integers(0, 50)}"
                if rng.random() < 0.3:
                    words = words + ["more"] * int(rng.integers(0, 3))
            rows.append((len(rows) * 3 % 1009 + 1009 * (len(rows) // 1009), " ".join(words)))
    return rows


@pytest.mark.parametrize("seed,top,k,num", [(1, 30, 3, 90), (2, 200, 3, 90), (3, 40, 5, 80), (4, 12, 1, 80)])
def test_equals_brute_force(spark, seed, top, k, num):
    rows = families(seed, 60, top)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(jj.join(df, words=k, num=num)) == brute(rows, k, num)


def test_whole_table_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert result(queries()["op10_jaccard_join"](spark, sf)) == brute(rows)


def test_edges(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(9, None), (8, ""), (7, " \t\n"), (6, "One two"), (5, "one  TWO"), (4, "one two three"),
            (3, "é\x0bß"), (2, "é ß"), (2, "é ß"), (1, "É ß"), (20, long), (21, long + " y"), (22, "zz " + long),
            (None, "one two"), (30, "same id first text here"), (30, "quite another one there now")]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows],
                               "doc_id long, text string, key string, node int")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id)
                 for r in jj.join(df).collect())
    assert got == sorted(brute([x for x in rows if x[0] is not None]) + [(-1, 1, None)], key=lambda x: x[:2])
    assert jj.join(df.limit(0)).collect() == []


def test_large_group_is_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(jj, "GROUP", 4)
    rng = np.random.default_rng(9)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(60):
        w = list(base)
        for at in rng.integers(0, 150, 3 + i % 9):
            w[at] = f"r{rng.integers(0, 10**6)}"
        rows.append((100 - i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(jj.join(df)) == brute(rows)


def test_outsiders_are_linked_before_all_pairs_are_compared(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(160):           # two edits: linked with the text without edits alone
        words = list(base)
        for at in rng.choice(150, 1 + i % 2 if i else 0, replace=False):
            words[at] = f"e{rng.integers(0, 9999)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    compared, emitted = jj.compared, []

    def counted(members, p, nearest=False):
        out = jj.written(compared(members, p, nearest))
        if nearest:
            assert out.groupBy("outsider").count().count() <= len(rows)
        else:
            emitted.append(out.count())
        return out

    monkeypatch.setattr(jj, "compared", counted)
    want = brute(rows)
    assert result(jj.join(docs)) == want
    monkeypatch.setattr(jj, "LINKING", 0)
    assert result(jj.join(docs)) == want
    assert emitted[0] < emitted[1]


def test_groups_are_compared_in_parts_and_one_component_is_not_written_again(spark, monkeypatch):
    """The blocks of all groups do not lie on disk at once, nor their rows once more for each round."""
    rng = np.random.default_rng(9)
    rows = []
    for f in range(12):                # six families of one component, six that lie around the threshold
        base = [f"f{f}w{i}" for i in range(150)]
        for i in range(30):
            words = list(base)
            for at in rng.choice(150, 4 if f % 2 else 0, replace=False):
                words[at] = f"e{rng.integers(0, 9999)}"
            rows.append((len(rows), " ".join(words) + (" end" if i % 3 else "")))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    compared, mixed, keys, known = jj.compared, jj.mixed_rows, [], []

    def part(members, p, nearest=False):
        if not nearest:
            keys.append({r.key for r in members.select("key").distinct().collect()})
        return compared(members, p, nearest)

    def written(slim, comp):
        out = mixed(slim, comp)
        known.append((slim.count(), out.count()))
        return out

    monkeypatch.setattr(jj, "compared", part)
    monkeypatch.setattr(jj, "mixed_rows", written)
    monkeypatch.setattr(jj, "LINKING", 0)
    want = brute(rows)
    assert result(jj.join(docs)) == want
    monkeypatch.setattr(jj, "PASS_ROWS", 0)
    assert result(jj.join(docs)) == want
    whole, *parts = keys
    assert len(parts) == jj.PASSES and set.union(*parts) == whole
    assert sum(map(len, parts)) == len(whole) and max(map(len, parts)) < 0.7 * len(whole)
    assert 0 < known[0][1] < known[0][0]


@pytest.mark.parametrize("num", [80, 90])
def test_allocation_covers_the_threshold(num):
    for rows in (100, 10**6, 10**11):
        p = jj.make_plan(num, 100, rows, 5000)
        for b in range(len(p.segs)):
            top = int(p.low[b + 1]) - 1
            most = int(p.differ(np.int64(top), np.int64(top * 100 // num)))
            assert (p.segs[b] + p.loose[b] == most + 1 + p.spare[b]) if most else p.segs[b] == 0
    assert jj.make_plan(80, 100, 10**11, 5000).loose.any()       # many rows: neighbourhoods pay


@pytest.mark.parametrize("loose", [0, 1, 3])
def test_linked_sets_always_share_a_key_whose_sketch_passes(loose):
    rng = np.random.default_rng(loose)
    p = jj.make_plan(80, 100, 1000, 3000)
    for b in range(len(p.segs)):
        if p.segs[b]:
            p.loose[b] = min(loose, p.segs[b] // 3)
            p.spare[b] += p.loose[b]
    every = np.full(jj.FILTER_BITS // 8 + 8192, 255, np.uint8)
    for _ in range(150):
        n = int(rng.integers(5, 700))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        drop = int(p.differ(np.int64(len(a)), np.int64(len(a))) // 2)
        keep = rng.permutation(len(a))[drop:]
        b = np.unique(np.r_[a[keep], rng.integers(0, 2**63, drop).astype(np.uint64)])
        both = len(np.intersect1d(a, b))
        if both * 100 < 80 * (len(a) + len(b) - both):
            continue
        rows = [{}, {}]
        size = np.array([len(a), len(b)])
        most = int(p.differ(*size))
        for d, key, own, gone, weights, span, byte, wide in jj.keys(np.r_[a, b], size, p, every):
            for i, x, g, w, at in zip(d, key, gone, weights.tolist(), span.tolist()):
                share = math.ceil((w & 255) * (most + 1 + (w >> 36)) / (w >> 8 & (1 << 28) - 1)) - 1
                lo = wide[i] + (at & (1 << 32) - 1)
                block, doc = byte[lo:lo + (at >> 32)], byte[wide[i]:wide[i + 1]]
                rows[i].setdefault(x, []).append((own, g, share, block, doc))
        assert np.array_equal(a, b) or any(
            (x[0] or y[0]) and not (x[1] and y[1]) and (x[3] != y[3]).sum() <= x[2]
            and (x[4] != y[4]).sum() <= most
            for k in rows[0].keys() & rows[1].keys() for x in rows[0][k] for y in rows[1][k])


def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(up)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_blocks_cover_all_segments():
    for m in (1, 5, 32, 33, 48, 100, 1755):
        first, after = jj._block(np.arange(m), np.full(m, m))
        assert first[0] == 0 and after[-1] == m and ((first <= np.arange(m)) & (np.arange(m) < after)).all()
        assert (after - first).max() <= jj.SINGLE and ((first[1:] == first[:-1]) | (first[1:] == after[:-1])).all()


def test_similar_texts_without_a_link_are_dismissed_in_the_task(spark, monkeypatch):
    """Texts of one template, most of them below the threshold: what is emitted
    does not grow with the square of their number."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(170)]
    rows = []
    for d in range(120):
        text = list(base)
        for i in rng.choice(170, 3, replace=False):
            text[i] = f"x{d}_{i}"
        rows.append((d, " ".join(text)))
    sets = [{tuple(t.split()[i:i + 5]) for i in range(166)} for _, t in rows]
    up = list(range(120))
    for i in range(120):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                x, y = up[i], up[j]
                up = [min(x, y) if u in (x, y) else u for u in up]
    emitted, real = [], jj.compared

    def counted(*args, **kwargs):
        out = real(*args, **kwargs)
        emitted.append(out.count())
        return out

    monkeypatch.setattr(jj, "compared", counted)
    monkeypatch.setattr(jj, "LINKING", 0)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jj.join(docs, words=5, num=80).collect()}
    assert got == dict(enumerate(up))
    assert emitted[0] <= 180


def test_similar_long_texts_without_a_link_are_dismissed_in_the_task(spark, monkeypatch):
    """Sets of some 170 segments: a part of their sketch lets many pairs just
    below the threshold through, under many keys."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(700)]
    rows = []
    for d in range(60):
        text = list(base)
        for i in rng.choice(700, 10, replace=False):
            text[i] = f"x{d}_{i}"
        rows.append((d, " ".join(text)))
    sets = [{tuple(t.split()[i:i + 5]) for i in range(696)} for _, t in rows]
    up = list(range(60))
    for i in range(60):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                x, y = up[i], up[j]
                up = [min(x, y) if u in (x, y) else u for u in up]
    assert len(set(up)) > 30
    emitted, real = [], jj.compared

    def counted(*args, **kwargs):
        out = real(*args, **kwargs)
        emitted.append(out.count())
        return out

    monkeypatch.setattr(jj, "compared", counted)
    monkeypatch.setattr(jj, "LINKING", 0)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jj.join(docs, words=5, num=80).collect()}
    assert got == dict(enumerate(up))
    assert emitted[0] <= 400


@pytest.mark.parametrize("part", [0, 0.1, 0.5, 1])
def test_no_block_weighs_more_than_its_packed_weight(part):
    for m in (1, 40, 100, 127, 128, 200, 240, 241, 500, 1755):
        loose = int(part * m)
        first, after = jj._block(np.arange(m), np.full(m, m), np.full(m, loose))
        assert first[0] == 0 and after[-1] == m and ((first <= np.arange(m)) & (np.arange(m) < after)).all()
        assert (after - first + np.clip(loose - first, 0, after - first)).max() <= 255
        assert ((after - first) * jj.FINE).max() <= jj.WIDTH
