"""Collocations, vector codes and source mixing against brute force, with odd rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cuadra.llm import collocations, cover_codes, mixing
from cuadra.llm.common import prepared

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Collocations

def phrases_by_hand(rows, least, top, longest=4, covered=80):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if a >= least}
        scored = []
        for p, a in candidates.items():
            if len(p) < 2:
                continue
            inside = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= covered * a for b in inside):
                continue
            score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def some_rows():
    r = random.Random(4)
    words = [f"w{i}" for i in range(12)] + ["Über", "ÉTÉ", "x y", "\x1c", "don't"]
    rows = []
    for i in range(60):
        text = "".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ", ", "\n", ".", "\r\n"]) for _ in range(r.randrange(0, 60)))
        rows.append((r.choice(["en", "de", None, "", "und"]), text))
    rows += [("en", "New York City Hall is here. new york City Hall")] * 7
    rows += [("en", None), (None, ""), ("de", " \t \n"), ("fr", "only once"), ("en", "w1 w2 " * 3000)]
    return rows


@pytest.mark.parametrize("bits, shard, block", [(64, 1 << 19, 1 << 18), (11, 23, 40)])
def test_collocations(spark, bits, shard, block):
    prepared(spark)
    rows = some_rows()
    # Columns whose names the operator uses inside.
    docs = spark.createDataFrame([(i, lang, text, 1, "c", [1], 2) for i, (lang, text) in enumerate(rows)],
                                 "doc_id long, lang string, text string, g int, code string, p array<int>, n int").repartition(3)
    got = collocations.collocations(docs, least=3, top=40, bits=bits, shard=shard, block_tokens=block)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == phrases_by_hand(rows, 3, 40)


def test_no_collocations(spark):
    docs = spark.createDataFrame([(1, "en", "a b c"), (2, None, None)], "doc_id long, lang string, text string")
    assert collocations.collocations(docs, least=2).count() == 0
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_trie_counts_what_a_scan_counts():
    r = np.random.default_rng(3)
    tokens = r.integers(-1, 6, 4000).astype(np.int32)
    codes = np.sort(r.choice(1 << 40, 6, replace=False)).astype(np.int64)
    want = Counter(tuple(codes[tokens[i:i + k]].tolist()) for k in range(1, 5) for i in range(len(tokens) - k + 1) if tokens[i:i + k].min() >= 0)
    some = [p for j, p in enumerate(sorted(want)) if j % 3]  # prefixes may be missing
    rows = np.array([[*p, *[0] * (4 - len(p))] for p in some], np.int64)
    trie = collocations.Trie.build(rows, np.array([len(p) for p in some]), np.arange(len(some)))
    trie = collocations.Trie.from_bytes(trie.to_bytes())
    into = np.zeros(len(trie.base), np.int64)
    trie.count(codes, tokens, into)
    found = {int(trie.accept[c]): int(into[c]) for c in np.flatnonzero(trie.accept >= 0)}
    assert found == {i: want[p] for i, p in enumerate(some)}


# Vector codes

def codes_by_hand(rows, parts=4, entries=256, rounds=4):
    kept = [(i, v, y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], ""
    width = -(-max(len(v) for _, v, _ in kept) // parts) * parts
    whole = [[math.floor(1024 * x) for x in v] + [0] * (width - len(v)) for _, v, _ in kept]
    cut = width // parts
    order = sorted(range(len(kept)), key=lambda j: (kept[j][0] is None, kept[j][0] or 0, whole[j]))
    books = [[whole[j][p * cut:(p + 1) * cut] for j in order[:entries]] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * cut:(p + 1) * cut], c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        members = defaultdict(list)
        for v in whole:
            for p in range(parts):
                members[p, nearest(p, v)[1]].append(v[p * cut:(p + 1) * cut])
        for (p, e), some in members.items():
            books[p][e] = [sum(c) // len(some) for c in zip(*some)]
    out = [(i, "".join(f"{nearest(p, v)[1]:02x}" for p in range(parts)), sum(nearest(p, v)[0] for p in range(parts)), y) for (i, _, y), v in zip(kept, whole)]
    by_label = Counter()
    for _, _, error, y in out:
        by_label[y] += error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted([(i, c, e, by_label[y]) for i, c, e, y in out], key=repr), digest


def some_vectors():
    r = random.Random(8)
    centres = [[r.gauss(0, 0.2) for _ in range(10)] for _ in range(5)]
    rows = [(i, [x + r.gauss(0, 0.02) for x in r.choice(centres)], r.choice([1, 2, None])) for i in range(150)]
    rows += [(i + 200, [0.5, -0.5] * 5, 1) for i in range(40)]  # copies
    rows += [(7, rows[7][1], 2), (7, rows[9][1], 2), (None, rows[3][1], 1), (None, None, 1)]
    rows += [(900, [], 3), (901, [0.25], 3), (902, [None] * 10, 3), (903, [float("nan")] * 10, 3), (904, [float("inf")] * 10, 3), (905, None, 3), (906, [-0.0001] * 10, 3)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("entries, chunk", [(256, 2048), (16, 30)])
def test_vector_codes(spark, entries, chunk):
    prepared(spark)
    rows = some_vectors()
    table = spark.createDataFrame([(i, v, y, 5, "t") for i, v, y in rows], "vec_id long, embedding array<double>, label int, v int, trees string").repartition(3)
    codes, books = cover_codes.vector_codes(table, entries=entries, chunk=chunk)
    got = [(r.vec_id, r.code, r.error, r.label_error) for r in cover_codes.with_label_error(codes).collect()]
    want, digest = codes_by_hand(rows, entries=entries)
    assert sorted(got, key=repr) == want
    assert cover_codes.digest(books) == digest


def test_vector_codes_of_nothing(spark):
    table = spark.createDataFrame([(1, None, 2)], "vec_id long, embedding array<float>, label int")
    codes, books = cover_codes.vector_codes(table)
    assert cover_codes.with_label_error(codes).count() == 0 and books == []
    far, _ = cover_codes.vector_codes(spark.createDataFrame([(1, [1e300, -1e300]), (2, [3e5, 0.0])], "vec_id long, embedding array<double>").selectExpr("*", "1 as label"))
    assert sorted(r.code for r in far.collect()) == ["00000000", "01010000"]


@pytest.mark.parametrize("scale", [30, 1 << 27])
def test_cover_tree(scale):
    r = np.random.default_rng(1)
    points = (r.normal(size=(8, 4))[r.integers(0, 8, 700)] * scale + r.normal(size=(700, 4)) * scale / 20).astype(np.int64)
    points[:50] = points[0]
    tree = cover_codes.CoverTree.build(points)
    for n in range(len(tree.centre)):
        apart = np.sqrt(((tree.rows[tree.begin[n]:tree.end[n]] - tree.rows[tree.centre[n]]).astype(float) ** 2).sum(1))
        assert apart.max() <= tree.radius[n] * (1 + 1e-9) and tree.begin[n] <= tree.centre[n] < tree.end[n]
        if tree.kids[n]:
            kids = slice(tree.child[n], tree.child[n] + tree.kids[n])
            assert tree.begin[kids][0] == tree.begin[n] and tree.end[kids][-1] == tree.end[n]
            centres = tree.rows[tree.centre[kids]].astype(float)
            gaps = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(2))[~np.eye(len(centres), dtype=bool)]
            assert gaps.min() > tree.radius[kids].max() * (1 - 1e-9)
    book = np.concatenate([points[::40], points[:3], points[::40] + 1])
    exact = ((points[:, None, :].astype(object) - book[None].astype(object)) ** 2).sum(2)
    label, error = tree.codes(book)
    assert label.tolist() == [min(range(len(book)), key=lambda e: (row[e], e)) for row in exact.tolist()]
    assert error.tolist() == [min(row) for row in exact.tolist()]
    begin, _, _ = tree.assign(points[[50, 300, 500]])
    assert len(begin) < len(tree.rows)  # whole subtrees were assigned


# Mixing

def targets_by_hand(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, rest = {}, dict(sizes)
    while True:
        left = 1.5 * sum(sizes.values()) - sum(full.values())
        share = {s: weight[s] * left / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > 2 * sizes[s]]
        if not over:
            return full | share
        for s in over:
            full[s] = 2.0 * sizes[s]
            del rest[s]


def mixed(spark, rows):
    prepared(spark)
    docs = spark.createDataFrame([(i, t, s, 1, 2, "k") for i, t, s in rows], "doc_id long, text string, source string, size int, nth int, key string")
    return mixing.mix(docs)


def test_mix(spark):
    r = random.Random(5)
    word = lambda n: "\x0b".join("ab c".replace(" ", " ") for _ in range(n))  # noqa: E731  no-break spaces part nothing
    rows = [(i, word(r.randrange(0, 30)), r.choice(["a", "a", "a", "b", "Z", "ä", None, ""])) for i in range(400)]
    rows += [(500, "w " * 20_000, "a"), (501, None, "b"), (None, "x y", "b"), (None, "x y", "b"), (501, "z", "empty"), (502, "", "void"), (502, " \t", "void")]
    got = mixed(spark, rows).collect()
    assert sorted((repr(x.doc_id), repr(x.source), x.size) for x in got) == sorted((repr(i), repr(s), len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, s in rows)
    sizes, taken, target = Counter(), Counter(), {}
    for x in got:
        sizes[x.source] += x.size
        taken[x.source] += x.taken
        target[x.source] = x.target
        assert x.epochs * x.size <= x.taken <= 2 * x.size
    for x in got:
        assert x.source_size == sizes[x.source]
    want = targets_by_hand(sizes)
    assert target == pytest.approx(want) and target["void"] == 0
    assert all(target[s] - 1 < taken[s] <= target[s] + 1e-6 for s in target)
    # At most one document of a source is cut.
    cut = Counter(x.source for x in got if x.size and x.taken % x.size)
    assert max(cut.values(), default=0) <= 1
    again = mixed(spark, rows[::-1]).collect()
    key = lambda x: (repr(x.doc_id), repr(x.source), x.size, x.taken)
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_mix_of_few_rows(spark):
    assert mixed(spark, []).count() == 0
    assert [x.taken for x in mixed(spark, [(1, None, None), (2, "", "a")]).collect()] == [0, 0]
    assert [x.taken for x in mixed(spark, [(1, "a b c d", "s")]).collect()] == [6]
    with pytest.raises(ValueError):
        mixing.source_targets(spark.createDataFrame([("s", 3)], "source string, size long"), share=(5, 2))
