"""Slack packing, Merkle manifest and sharded k-means against brute force, on awkward rows and on none."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shelfsight.llm import merkle, sharded_kmeans, slack_packing
from shelfsight.llm.common import tokenizer_file
from shelfsight.llm.encode import Encoder

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree long, row long, length long"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["Alpha", "beta", "Ünï", "x|y", "12:3"]) for _ in range(rng.randint(0, 300))) for _ in range(700)]
    texts += [None, "", "  ", "word " * 9000, texts[3], texts[3]]
    rows = [(k, t, "en", f"s{k % 3}" if k % 4 else None, len(t or "") if k % 5 else None, 1, 2, 3) for k, t in enumerate(texts)]
    rows += [(k, "Short Text", "éa" if k % 2 else "de", None, 3, 0, 0, 0) for k in range(1000, 1012)]
    rows += [(1, "lone", "zz", "", 4, 9, 9, 9), (5, "No Lang", None, "s", 7, 1, 1, 1), (None, "No Id", "en", "s", 5, 1, 1, 1)]
    return rows + [rows[7], rows[7], (7, "another", "en", None, None, 0, 0, 0), (None, "No Id", "en", "s", 5, 1, 1, 1)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def sums_up_to(left, room):
    best = {0}
    for n, k in enumerate(left):
        best = {s + n * j for s in best for j in range(k + 1) if s + n * j <= room}
    return best


def test_fill_is_closest_to_the_room():
    rng = random.Random(2)
    for _ in range(2000):
        left = [0, *[rng.choice([0, 0, 0, 1, 2, 5]) for _ in range(rng.randint(1, 20))]]
        room = rng.randint(0, 40)
        found = slack_packing.fill(left, room)
        assert all(1 <= k <= left[n] for n, k in found.items())
        assert sum(n * k for n, k in found.items()) == max(sums_up_to(left, room))


def laid(counts, capacity):
    """All parts of all pieces: (length, rank), ids from, how many, sequence, offset."""
    found = slack_packing.places(slack_packing.plan(counts, capacity), capacity)
    lengths = np.repeat(np.arange(len(counts)), counts)
    ranks = np.concatenate([np.arange(c) for c in counts])
    item, *rest = slack_packing.placed(found, lengths, ranks)
    return [((int(lengths[i]), int(ranks[i])), *map(int, r)) for i, *r in zip(item, *rest)]


def holds_all(counts, capacity):
    parts, pieces, sequences = laid(counts, capacity), {}, {}
    for piece, inside, size, sequence, offset in parts:
        assert size > 0
        pieces.setdefault(piece, []).append((inside, size))
        sequences.setdefault(sequence, []).append((offset, size))
    assert len(pieces) == counts.sum()
    for (length, _), own in pieces.items():
        assert [a for a, _ in sorted(own)] == [0, *itertools.accumulate(n for _, n in sorted(own))][:-1]
        assert sum(n for _, n in own) == length
    for own in sequences.values():
        assert [a for a, _ in sorted(own)] == [0, *itertools.accumulate(n for _, n in sorted(own))][:-1]
        total = sum(n for _, n in own)
        assert total == capacity or total < capacity and total & (total - 1) == 0
    return len(parts) - len(pieces)


def test_plans_place_every_id_once_without_padding():
    rng = np.random.default_rng(4)
    for _ in range(200):
        capacity = int(rng.integers(1, 50))
        counts = rng.integers(0, 7, capacity + 1) * (rng.random(capacity + 1) < 0.5)
        counts[0] = 0
        holds_all(counts, capacity)


def test_pieces_are_cut_only_where_no_multiset_fills_the_window():
    counts = np.zeros(1025, dtype=np.int64)
    for length, n in ((1000, 10), (24, 4), (12, 12), (700, 8), (300, 8), (8, 24), (1024, 3)):
        counts[length] = n
    assert holds_all(counts, 1024) == 0
    many = np.zeros(1025, dtype=np.int64)
    many[600] = 1 << 40
    kinds = slack_packing.plan(many)
    assert sum(r.count * r.size for r in kinds) == 600 << 40 and len(kinds) < 1000


def test_a_plan_that_runs_out_of_kinds_still_places_everything(monkeypatch):
    monkeypatch.setattr(slack_packing, "MOST_KINDS", 0)
    counts = np.arange(33)
    holds_all(counts, 32)


def test_slack_packing(docs, empty, rows):
    path = tokenizer_file("byte_bpe_50k.json")
    found = slack_packing.pack(slack_packing.document_pieces(docs, path, 0)).collect()
    coder, want = Encoder(path), Counter()
    for r in rows:
        ids = np.array([*coder.tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want[r[0], ids.tobytes()] += 1
    by_doc, sequences = {}, {}
    for g in found:
        by_doc.setdefault((g.doc_id, g.doc_tokens), []).append((g.start, g.length, g.ids_crc32))
        sequences.setdefault(g.sequence_id, []).append((g.offset, g.length))
    tokens = Counter()
    for (doc, ids), times in want.items():
        tokens[doc, len(ids) // 4] += times * len(ids) // 4
        for start, length, crc in by_doc[doc, len(ids) // 4]:
            texts = [i for (d, i) in want if d == doc and len(i) == len(ids)]
            assert crc in {zlib.crc32(i[4 * start : 4 * (start + length)]) for i in texts}
    assert {k: sum(n for _, n, _ in v) for k, v in by_doc.items()} == dict(tokens)
    for own in sequences.values():
        assert [a for a, _ in sorted(own)] == [0, *itertools.accumulate(n for _, n in sorted(own))][:-1]
        total = sum(n for _, n in own)
        assert total == 1024 or total < 1024 and total & (total - 1) == 0
    assert slack_packing.pack(slack_packing.document_pieces(empty, path, 0)).count() == 0


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """All levels, from the leaves to the single root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(below[k : k + 8]) for k in range(0, len(below), 8)])
    return levels


def climb(levels, index, node):
    proof = []
    for nodes in levels[:-1]:
        low = index // 8 * 8
        run = nodes[low : low + 8]
        proof += [x for k, x in enumerate(run) if k != index - low]
        run[index - low] = node
        node, index = h(run), index // 8
    return proof, node


def test_positions_are_a_postorder():
    for leaves in [*range(1, 140), 511, 512, 513, 4096, 4097, 5000]:
        order, levels = [], [leaves]
        while levels[-1] > 1:
            levels.append(-(-levels[-1] // 8))

        def visit(level, index):
            if level:
                for child in range(index * 8, min(index * 8 + 8, levels[level - 1])):
                    visit(level - 1, child)
            order.append((level, index))

        visit(len(levels) - 1, 0)
        assert merkle.height(leaves) == len(levels) - 1
        for level, n in enumerate(levels):
            mine = merkle.position(level, np.arange(n), leaves)
            assert [order[p] for p in mine.tolist()] == [(level, k) for k in range(n)]


def test_builders_append_in_completion_order():
    for leaves in (1, 5, 8, 9, 100, 512):
        rows = list(merkle.built(0, 0, [bytes([k % 251]) * 32 for k in range(leaves)], leaves))
        assert [at for _, at, _ in rows] == sorted(at for _, at, _ in rows)
        levels = tree([(bytes([k % 251]) * 32).hex() for k in range(leaves)])
        assert Counter((k, d.hex()) for k, _, d in rows) == Counter((k, x) for k, own in enumerate(levels) if k for x in own)


def test_merkle_manifest(docs, empty, rows):
    def leaf(r, text):
        fields = (r[0], r[3], r[2], r[4], text)
        return h("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields)

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))) for x in langs}
    trees = {x: tree([leaf(r, r[1]) for r in own[x]]) for x in langs}
    top = tree([trees[x][-1][0] for x in langs])
    want = Counter()
    for place, x in enumerate(langs):
        for index, r in enumerate(own[x]):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            changed = leaf(r, r[1].translate(LOW)) if tampered and r[1] is not None else leaf(r, r[1])
            proof, node = climb(trees[x], index, changed)
            more, node = climb(top, place, node)
            want[r[0], leaf(r, r[1]), trees[x][-1][0], top[-1][0], h(proof + more), node, node == top[-1][0]] += 1
    got = merkle.manifest(docs)
    assert Counter(tuple(g) for g in got.collect()) == want
    assert {True, False} == {w[-1] for w in want}
    assert merkle.manifest(empty).count() == 0


def test_a_deep_tree_needs_a_second_tier_of_builders(spark):
    docs = spark.range(1500).selectExpr("id as doc_id", "cast(id as string) as text", "'en' as lang", "'s' as source", "id as n_chars")
    levels = tree([h(f"{len(str(x))}:{x}" for x in (k, "s", "en", k, k)) for k in range(1500)])
    got = merkle.manifest(docs).filter("doc_id in (0, 511, 512, 1499)").collect()
    assert len(got) == 4
    for g in got:
        assert g.root == levels[-1][0] and g.verified and g.proof_sha256 == h(climb(levels, g.doc_id, g.leaf)[0])


def lloyd(vectors, k, rounds, seed):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in vectors if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centre = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for step in range(rounds + 1):
        near = [min((far(v, c), n) for n, c in enumerate(centre)) for _, v in kept]
        if step < rounds:
            for n in range(len(centre)):
                own = [v for (_, v), (_, m) in zip(kept, near) if m == n]
                if own:
                    centre[n] = [sum(x) // len(own) for x in zip(*own)]
    total = Counter()
    for d, n in near:
        total[n] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre]
    return Counter((i, n, d, total[n], sum(total.values()), sha[n]) for (i, _), (d, n) in zip(kept, near))


def test_sharded_kmeans(spark):
    rng = random.Random(6)
    single = lambda x: float(np.float32(x))
    vectors = [(k, [single(rng.gauss(k % 7 - 3, 1)) for _ in range(64)]) for k in range(300)]
    vectors += [vectors[3], vectors[3], (None, vectors[5][1]), (3, vectors[9][1]), (400, [0.0] * 64), (401, [-1e4] * 64)]
    vectors += [(500, None), (501, []), (502, [1.0] * 63), (503, [None] + [1.0] * 63), (504, [float("nan")] * 64), (505, [float("-inf")] * 64)]
    df = spark.createDataFrame([(*v, 1, "x") for v in vectors], "vec_id long, embedding array<float>, cluster long, block string")
    want = lloyd(vectors, 16, 3, 1)
    for settings in ({}, {"shards": 1}, {"shards": 7, "block_rows": 13}):
        assert Counter(tuple(g) for g in sharded_kmeans.clusters(df.repartition(3), **settings).collect()) == want
    few = sharded_kmeans.clusters(df.filter("vec_id < 5"), k=16)
    assert Counter(tuple(g) for g in few.collect()) == lloyd([v for v in vectors if v[0] is not None and v[0] < 5], 16, 3, 1)
    assert sharded_kmeans.clusters(df.limit(0)).count() == 0
    huge = spark.createDataFrame([(1, [3e38] * 64), (2, [-3e38] * 64), (3, [0.0] * 64)], "vec_id long, embedding array<float>")
    assert sharded_kmeans.clusters(huge, k=1).count() == 3
